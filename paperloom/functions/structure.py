"""Is the content of a file sound, by the structure of its container?

Each check walks the container's own lengths and offsets once, from its first byte to its
end mark, and decodes no pixels or pages. A file cut short, or damaged where the structure
lies, fails; damage inside compressed data fails only where the format has checksums.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable

PNG = b"\x89PNG\r\n\x1a\n"


def sound_png(data: memoryview) -> bool:
    """Signature, then chunks whose checksums hold: IHDR first, IDAT among them, IEND last."""
    if data[:8] != PNG:
        return False
    at, kinds = 8, []
    while at + 12 <= len(data):
        (length,), kind = struct.unpack(">I", data[at:at + 4]), bytes(data[at + 4:at + 8])
        end = at + 12 + length
        if end > len(data) or zlib.crc32(data[at + 4:end - 4]) != int.from_bytes(data[end - 4:end], "big"):
            return False
        kinds.append(kind)
        at = end
        if kind == b"IEND":
            break
    return kinds[:1] == [b"IHDR"] and kinds[-1] == b"IEND" and b"IDAT" in kinds


#: End of the coded data behind a JPEG scan header: a marker that is neither a stuffed byte nor a restart.
_NEXT_MARKER = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]", re.S)


def sound_jpeg(data: memoryview) -> bool:
    """Segments from SOI to EOI: a frame, and a scan with its coded data up to a marker."""
    if data[:2] != b"\xff\xd8":
        return False
    at, frame, scan = 2, False, False
    while at + 2 <= len(data) and data[at] == 0xFF:
        marker = data[at + 1]
        if marker == 0xFF:  # fill byte
            at += 1
            continue
        if marker == 0xD9:
            return frame and scan
        if at + 4 > len(data):
            return False
        end = at + 2 + int.from_bytes(data[at + 2:at + 4], "big")
        if end < at + 4 or end > len(data):
            return False
        frame = frame or 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC)
        if marker == 0xDA:
            scan = True
            found = _NEXT_MARKER.search(data, end)
            if found is None:
                return False
            end = found.start()
        at = end
    return False


#: Bytes of a value of each TIFF field type.
_TIFF_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


def sound_tiff(data: memoryview) -> bool:
    """Directories whose fields, values and strips or tiles all lie within the file."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(bytes(data[:4]))
    if order is None or len(data) < 8:
        return False

    def numbers(kind: int, count: int, at: int) -> tuple[int, ...]:
        return struct.unpack(f"{order}{count}{'H' if kind == 3 else 'I'}", data[at:at + count * _TIFF_SIZES[kind]])

    (at,), seen = struct.unpack(f"{order}I", data[4:8]), set()
    while at:
        if at in seen or at + 2 > len(data):
            return False
        seen.add(at)
        (count,) = struct.unpack(f"{order}H", data[at:at + 2])
        end = at + 2 + 12 * count
        if not count or end + 4 > len(data):
            return False
        parts: dict[int, tuple[int, ...]] = {}
        for field in range(at + 2, end, 12):
            tag, kind, n = struct.unpack(f"{order}HHI", data[field:field + 8])
            size = _TIFF_SIZES.get(kind, 1) * n
            place = field + 8 if size <= 4 else struct.unpack(f"{order}I", data[field + 8:field + 12])[0]
            if place + size > len(data):
                return False
            if tag in (273, 279, 324, 325) and kind in (3, 4):  # offsets and lengths of strips, of tiles
                parts[tag] = numbers(kind, n, place)
        for offsets, lengths in ((273, 279), (324, 325)):
            pairs = zip(parts.get(offsets, ()), parts.get(lengths, ()))
            if len(parts.get(offsets, ())) != len(parts.get(lengths, ())) or any(a + n > len(data) for a, n in pairs):
                return False
        (at,) = struct.unpack(f"{order}I", data[end:end + 4])
    return bool(seen)


_START = re.compile(rb"startxref\s+(\d+)\s+%%EOF\s*$")
_CROSS = re.compile(rb"xref\s|\d+\s+\d+\s+obj\b")


def sound_pdf(data: memoryview) -> bool:
    """Header, and a trailer whose offset leads to a cross-reference table or stream."""
    if data[:5] != b"%PDF-":
        return False
    tail = bytes(data[-2048:]).rstrip(b"\0 \r\n\t")
    found = _START.search(tail)
    return found is not None and _CROSS.match(data, int(found[1])) is not None


CHECKS: dict[str, Callable[[memoryview], bool]] = {
    ".png": sound_png, ".jpg": sound_jpeg, ".jpeg": sound_jpeg, ".tif": sound_tiff, ".tiff": sound_tiff, ".pdf": sound_pdf,
}


def is_sound(extension: str, content: bytes | memoryview) -> bool | None:
    """Whether the content is whole, or None for an extension without a check."""
    check = CHECKS.get(extension)
    if check is None:
        return None
    try:
        return check(memoryview(content).cast("B"))  # a buffer of Arrow has signed bytes
    except (struct.error, ValueError):
        return False
