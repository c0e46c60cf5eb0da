"""The entry points without the optional part, or without what it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

from paperloom import registry

registry.load()
ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import sys
sys.modules[{missing!r}] = None  # an import of it raises ImportError
import __spark_entry__ as entry
print(*entry.queries())
"""


@pytest.mark.parametrize("missing", ["public_tokenizers", "paperloom.llm", "corpus_pipeline"])
def test_own_queries_stay_without_the_optional_part(missing):
    said = subprocess.run([sys.executable, "-B", "-c", PROGRAM.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, check=True)
    assert set(said.stdout.split()) == set(registry.QUERIES)
