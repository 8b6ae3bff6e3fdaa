"""Row encodings and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_row(columns: Sequence[str]) -> Column:
    """One string per row that no other row content can produce.

    Each field carries its length, so ("a", "bc") and ("ab", "c") differ; null has its own mark.
    """
    fields = [
        F.coalesce(
            F.concat(
                F.length(F.col(name).cast("string")).cast("string"),
                F.lit(":"),
                F.col(name).cast("string"),
                F.lit(";"),
            ),
            F.lit("~;"),
        )
        for name in columns
    ]
    return F.concat(*fields)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the encoded row as 32 bytes: what a shuffle moves instead of the row."""
    return F.unhex(F.sha2(encode_row(columns), 256))


def hash_int(digest: Column, digits: int = 15) -> Column:
    """Leading hex digits of a digest as a whole number (15 digits = 60 bits)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("decimal(20,0)")


def seeded_key(seed: int, row_id: Column) -> Column:
    """Pseudo-random but reproducible sort key, unique per row id."""
    identifier = row_id.cast("string")
    return F.concat(
        F.md5(F.concat(F.lit(f"{seed}:"), identifier)), F.lit(":"), identifier
    )
