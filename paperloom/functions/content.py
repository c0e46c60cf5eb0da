"""Expressions over file bytes and where they are kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom import constants as C


def content_md5(content: Column) -> Column:
    return F.md5(content)


def content_location(available: Column, external: Column) -> Column:
    """embedded / external / unavailable."""
    return (
        F.when(available, "embedded")
        .when(external.isNotNull() & (external != ""), "external")
        .otherwise("unavailable")
    )


def signature_matches(extension: Column, content: Column) -> Column:
    """Do the leading bytes fit the extension? Null for extensions without a signature."""

    def starts(hex_forms: list[str]) -> Column:
        tests = [F.startswith(content, F.unhex(F.lit(h))) for h in hex_forms]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))

    return reduce(
        lambda acc, item: acc.when(extension == item[0], starts(item[1])),
        C.SIGNATURES.items(),
        F,
    )


def chunk_count(size: Column, max_bytes: int, chunk_bytes: int) -> Column:
    """Rows needed for a file: more than one only above `max_bytes`."""
    many = F.ceil(size / F.lit(chunk_bytes)).cast("int")
    return F.when(size > max_bytes, many).otherwise(F.lit(1))
