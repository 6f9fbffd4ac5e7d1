"""Portable, seedable row hash used by every sample, split and fold.

The bucket is the first 32 bits of md5("<key>-<seed>") modulo ``modulus``.
md5 is available with identical output in Spark and in ordinary SQL engines,
so samples and splits can be reproduced outside Spark (the test oracle does
exactly that). Different seeds give independent buckets, unlike an affine
``key * c mod m`` rule which only shifts a fixed pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_bucket(key: Column | str, seed: int | Column, modulus: int = 1000) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    s = seed if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat(k.cast("string"), F.lit("-"), s.cast("string")))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return head % F.lit(modulus)


def portable_bucket_sql(key_sql: str, seed: int, modulus: int = 1000) -> str:
    """The same bucket as ANSI-ish SQL text (used by the oracle queries)."""
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '-' || '{seed}'), 1, 8))"
            f"::BIGINT % {modulus})")


def portable_row_id(*cols: Column | str) -> Column:
    """60-bit row id from md5 of the '|'-joined key columns (reproducible in SQL)."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def portable_row_id_sql(*cols_sql: str) -> str:
    inner = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols_sql)
    return f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, 15))::BIGINT)"
