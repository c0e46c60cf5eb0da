"""Fixed values that decide results; they must not be tuned."""

# File class by lower-case extension; anything else is "other".
FILE_TYPES = {
    "image": [".jpg", ".jpeg", ".tif", ".tiff", ".png"],
    "text": [".txt", ".md", ".json"],
    "audio": [".wav", ".mp3"],
    "video": [".mp4", ".mov"],
    "document": [".pdf", ".xls", ".xlsx"],
}
OTHER_TYPE = "other"

# Path substrings left out when converting, and when publishing.
CONVERT_EXCLUDES = [".manifest.json", "__MACOSX", ".DS_Store"]
PUBLISH_EXCLUDES = [".manifest.json", "__MACOSX", ".DS_Store", "dedupe_report.json"]
REPORT_EXCLUDES = ["dedupe_report.json"]

# Sizes in bytes.
MAX_FILE_BYTES = 2_000_000_000
CHUNK_BYTES = 1_000_000_000
MAX_SHARD_BYTES = 500 * 1024 * 1024
SAMPLE_MAX_BYTES = 100 * 1024 * 1024
MB = 1_048_576
GB = 1_073_741_824

# Row counts of samples and reports.
SAMPLE_ROWS = 50
CONFLICT_SAMPLE_ROWS = 20
FAILED_SAMPLE_ROWS = 10
TOP_VALUES = 5
BATCH_ROWS = 100
PREVIEW_CHARS = 50

# Names.
MANIFEST_NAME = ".manifest.json"
LARGE_SUBSET = "large_files"
LARGE_PREFIX = "large_files/"
FOLDER_MIME = "application/vnd.google-apps.folder"

# Leading bytes (hex) that identify usable content.
SIGNATURES = {
    ".pdf": ["25504446"],
    ".jpg": ["FFD8FF"],
    ".jpeg": ["FFD8FF"],
    ".png": ["89504E47"],
    ".tif": ["49492A00", "4D4D002A"],
    ".tiff": ["49492A00", "4D4D002A"],
}
