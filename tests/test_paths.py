"""Path functions against the Python standard library."""

from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from paperloom.functions import content, paths

NAMES = [
    "a.JPG", "ab.tar.gz", "noext", "dot.", ".hidden", "..foo", "d.x/file", "d.x/.bashrc", "a/b.c/d.TXT",
    "sp ace/p%20 é.pdf", "x.É", "a..b", "tab\t.md", "line\n.txt", "..", "a.b/", "trailing.space ",
]


def test_file_extension_is_the_suffix(spark):
    df = spark.createDataFrame([(n,) for n in NAMES if not n.endswith("/")], "p string")
    got = dict(df.select("p", paths.file_extension(F.col("p"))).collect())
    assert got == {n: PurePosixPath(n).suffix.lower() for n in got}


@pytest.mark.parametrize(
    "extension,kind",
    [(".tiff", "image"), (".json", "text"), (".mp3", "audio"), (".mov", "video"), (".xls", "document"),
     (".docx", "other"), ("", "other")],
)
def test_file_type(spark, extension, kind):
    assert spark.range(1).select(paths.file_type(F.lit(extension))).first()[0] == kind


URLS = [
    "https://x.org/a/b.pdf", "https://x.org/a/b%20c.pdf?q=1", "https://x.org/a/", "https://x.org", "https://x.org/",
    "http://x.org/a+b.txt#frag", "http://x.org/p;v=1", "http://x.org/%E2%82%AC.txt", "http://x.org/with space.txt",
    "http://x.org/bad%zz", "http://x.org/a/./", "http://x.org/a%2Fb.txt",
]


def test_url_filename(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    got = dict(df.select("u", paths.url_filename(F.col("u"))).collect())
    want = {u: PurePosixPath(unquote(urlparse(u).path)).name or None for u in URLS}
    assert got == want


def test_matching_is_by_substring_and_null_safe(spark):
    rows = [("a/.manifest.json.bak.1",), ("a%b",), ("axb",), (None,)]
    df = spark.createDataFrame(rows, "path string")
    got = df.select(
        "path",
        paths.matches_any(F.col("path"), [".manifest.json", "a%b"]).alias("any"),
        paths.matches_none(F.col("path"), [".manifest.json", "a%b"]).alias("none"),
        paths.matches_none(F.col("path"), []).alias("no_patterns"),
    ).collect()
    assert [(r["any"], r["none"], r["no_patterns"]) for r in got] == [
        (True, False, True), (True, False, True), (False, True, True), (False, True, True)]


def test_content_location(spark):
    rows = [(True, "x"), (False, "x"), (False, None), (None, ""), (None, "y")]
    df = spark.createDataFrame(rows, "a boolean, e string")
    got = [r[0] for r in df.select(content.content_location(F.col("a"), F.col("e"))).collect()]
    assert got == ["embedded", "external", "unavailable", "unavailable", "external"]


def test_signatures(spark):
    rows = [
        (".pdf", b"%PDF-1.4"), (".pdf", b"PDF"), (".jpg", b"\xff\xd8\xff\xe0"), (".jpeg", b"\xff\xd8"),
        (".png", b"\x89PNG\r\n"), (".tif", b"II*\x00"), (".tiff", b"MM\x00*"), (".tiff", b"MMxx"), (".txt", b"x"),
        (".pdf", None),
    ]
    df = spark.createDataFrame(rows, "e string, c binary")
    got = [r[0] for r in df.select(content.signature_matches(F.col("e"), F.col("c"))).collect()]
    assert got == [True, False, True, False, True, True, True, False, None, False]
