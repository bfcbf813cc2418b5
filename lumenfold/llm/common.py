"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A list is broadcast up to this many bytes; a longer one is worked off in blocks of that size.
BLOCK_BYTES = 16 << 20


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Plain ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digest(text: Column) -> Column:
    """16 bytes that stand for a text; equal texts share all results that depend on the text only."""
    return F.unhex(F.md5(text))


def byte_blocks(df: DataFrame, column: str, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """``df`` cut by a hash of ``column`` into blocks of about ``block_bytes``, each marked for broadcast."""
    row = F.octet_length(F.col(column).cast("binary")) + F.lit(64 + 16 * len(df.columns))
    total = df.agg(F.sum(row.cast("long")).alias("b")).first()["b"] or 0
    n = -(-total // block_bytes)
    if n <= 1:
        return [F.broadcast(df)]
    return [F.broadcast(df.where(F.pmod(F.xxhash64(column), F.lit(n)) == b)) for b in range(n)]
