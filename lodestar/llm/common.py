"""Helpers shared by the corpus operators.

Identity of documents: a row's ``doc_id`` names its document. A null id is an
id of its own that sorts after all others (``id_key``). Rows may repeat; where
an operator has to bring results back to rows it joins on the id together with
a hash of the text (``text_key``), so that two texts under one id stay apart
and repeated rows each get the same result. Extra columns pass through under
any name; one with the name of an operator's result is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_path

#: Sort key of a null id: after every real id.
NULL_ID = 2**63 - 1


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def id_value(col: str | Column) -> Column:
    """The id behind an ``id_key``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != F.lit(NULL_ID), c)


def text_of(col: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def text_key(col: str = "text") -> Column:
    return F.xxhash64(text_of(col))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.

    Texts of ASCII characters only take the fast built-in; the byte length
    tells them apart.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, upper, upper.lower()))


def spare_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted`` as column names that none of ``taken`` has, whatever its case: underscores go in front."""
    held = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return out


def without(columns: Iterable[str], results: Iterable[str]) -> list[str]:
    """``columns`` without those that have a result's name: results take their place."""
    made = {c.lower() for c in results}
    return [c for c in columns if c.lower() not in made]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a place that every executor sees and that outlives any
    of them; later steps reread files instead of recomputing.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
