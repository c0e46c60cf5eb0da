"""Containers of files: whole ones are sound, and no part of them is."""

import hashlib
import struct
import zlib

import pytest

from paperloom.functions.structure import is_sound
from paperloom.operators.validation import structure_probe
from paperloom.schema import ARCHIVE
from paperloom.sources.digests import file_digests


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png():
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b""))


def segment(marker, data):
    return bytes([0xFF, marker]) + struct.pack(">H", len(data) + 2) + data


def jpeg():
    return (b"\xff\xd8" + segment(0xE0, b"JFIF\0") + b"\xff" + segment(0xDB, bytes(65)) + segment(0xC2, bytes(9)) + segment(0xDA, bytes(6))
            + b"ab\xff\x00c\xff\xd0d" + segment(0xC4, bytes(4)) + segment(0xDA, bytes(6)) + b"more" + b"\xff\xd9")


def tiff(order="<", tiles=False):
    mark = b"II*\0" if order == "<" else b"MM\0*"
    data = b"pixels" * 3
    offsets, lengths = (324, 325) if tiles else (273, 279)
    fields = [(256, 3, 1, 7), (offsets, 4, 1, 8), (lengths, 4, 1, len(data))]
    packed = b"".join(struct.pack(f"{order}HHI", *f[:3]) + (struct.pack(f"{order}HH", f[3], 0) if f[1] == 3 else struct.pack(f"{order}I", f[3])) for f in fields)
    return mark + struct.pack(f"{order}I", 8 + len(data)) + data + struct.pack(f"{order}H", 3) + packed + struct.pack(f"{order}I", 0)


def pdf(stream=False):
    body = b"%PDF-1.7\n1 0 obj << >> endobj\n"
    cross = b"2 0 obj << /Type /XRef >> endobj\n" if stream else b"xref\n0 1\n0000000000 65535 f \ntrailer << >>\n"
    return body + cross + b"startxref\n%d\n%%%%EOF\n" % len(body)


FILES = {".png": [png()], ".jpg": [jpeg()], ".jpeg": [jpeg()], ".tif": [tiff(), tiff(">"), tiff(tiles=True)], ".tiff": [tiff()],
         ".pdf": [pdf(), pdf(True)]}


@pytest.mark.parametrize("extension", FILES)
def test_whole_files_are_sound_and_parts_are_not(extension):
    for data in FILES[extension]:
        assert is_sound(extension, data)
        end = len(data.rstrip(b"\n"))
        assert not any(is_sound(extension, data[:n]) for n in range(end))
        assert not is_sound(extension, b"") and not is_sound(extension, b"x" + data)
    assert is_sound(".txt", b"x") is None


def test_damaged_structures():
    data = bytearray(png())
    for k in range(len(data)):
        data[k] ^= 1
        assert not is_sound(".png", data)
        data[k] ^= 1
    assert not is_sound(".pdf", pdf().replace(b"startxref\n30", b"startxref\n31"))
    assert not is_sound(".tif", tiff()[:4] + struct.pack("<I", 4) + tiff()[8:])
    assert not is_sound(".jpg", jpeg().replace(b"\xff\xc2", b"\xff\xe2"))  # no frame


def test_probe_counts_damaged_files(spark):
    rows = [(f"{i}{e}", "s", "x", 1, e, bytearray(d if i else d[:len(d) // 2]), True, 0, 1) for i in range(3) for e, all_ in FILES.items() for d in all_[:1]]
    rows += [("no.png", "s", "x", 1, ".png", None, False, 0, 1), ("null.png", "t", "x", 1, ".png", None, True, None, None),
             ("part.png", "s", "x", 1, ".png", bytearray(b"x"), True, 0, 2)]
    got = {(r.source, r.extension): (r.tested, r.damaged, r.example) for r in structure_probe(spark.createDataFrame(rows, ARCHIVE)).collect()}
    assert got == {("s", e): (3, 1, f"0{e}") for e in FILES} | {("t", ".png"): (1, 1, "null.png")}


def test_digests_of_chunked_files(spark):
    big = bytes(range(256)) * 40
    rows = [("whole", "s", "x", 1, "", bytearray(b"w"), True, None, None), ("whole", "r", "x", 0, "", bytearray(), True, 0, 1), ("outside", "s", "x", 9, "", None, False, 0, 1)]
    rows += [("big", "s", "x", 1, "", bytearray(big[k * 1024:(k + 1) * 1024]), True, k, 10) for k in reversed(range(10))]
    rows += [("gap", "s", "x", 1, "", bytearray(b"g"), True, k, 3) for k in (0, 2)] + [("short", "s", "x", 1, "", bytearray(b"g"), True, 0, 2)]
    rows += [("twice", "s", "x", 1, "", bytearray(b"g"), True, k, 2) for k in (0, 1, 1)] + [("null", "s", "x", 1, "", None, True, 0, 2), ("null", "s", "x", 1, "", bytearray(b"n"), True, 1, 2)]
    got = {(r.source, r.path): (r.file_size, r.md5) for r in file_digests(spark.createDataFrame(rows, ARCHIVE).repartition(5)).collect()}
    md5 = lambda x: hashlib.md5(x).hexdigest()
    lost = {("s", p): (None, None) for p in ("gap", "short", "twice", "null")}
    assert got == lost | {("s", "whole"): (1, md5(b"w")), ("r", "whole"): (0, md5(b"")), ("s", "big"): (len(big), md5(big))}
    plain = spark.createDataFrame(rows[:1], ARCHIVE).drop("chunk_index", "total_chunks")
    assert [r.md5 for r in file_digests(plain).collect()] == [md5(b"w")]
