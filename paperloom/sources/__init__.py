"""Reading and writing file trees, archives, manifests and reports."""
