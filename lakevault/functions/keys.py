"""Hash keys, change hashes and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def _joined(parts: list[Column]) -> Column:
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(part)
    return F.concat(*pieces)


def joined(*cols: str | Column) -> Column:
    """The text that :func:`hash_key` takes of several columns: keys with equal texts are equal."""
    return _joined([_col(c).cast("string") for c in cols])


def hash_key(*cols: str | Column) -> Column:
    """SHA-256 hex of the business key; a NULL part makes the whole key NULL."""
    return F.sha2(joined(*cols), 256)


def hashdiff(*cols: str | Column) -> Column:
    """SHA-256 hex of the attribute values; NULL and empty text count as the same value."""
    return F.sha2(_joined([F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]), 256)


def pseudonym(col: str | Column) -> Column:
    """First 16 hex digits of the SHA-256 of a personal value; NULL stays NULL."""
    return F.substring(F.sha2(_col(col).cast("string"), 256), 1, 16)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
