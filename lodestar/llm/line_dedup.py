"""Line dedup: documents probe sharded minimal-perfect-hash arrays of line counts.

A line's key is the line with white space stripped at both ends and A-Z
lower-cased. All distinct keys are counted, cut into shards by their hash, and
each shard becomes a minimal perfect hash over its keys with three arrays
beside it: a fingerprint, the number of lines, and the smallest document that
holds the key (-1 while only one document holds it). Documents send the hashes
of their lines to the shards and look them up there; no line text is shuffled
and no table of lines is joined.

Defined results: a null or empty text is one empty line; repeated rows count as
one document; a null ``doc_id`` is an id of its own, after all others; other
columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import ascii_lower, id_key, spare_names, stored, text_key, text_of, without

# The characters stripped from the ends of a line.
STRIPPED = " \t\n\x0b\f\r"
#: Distinct keys in a shard, about; bounds the memory of a task that builds or probes one.
SHARD_KEYS = 50_000
#: Levels of a minimal perfect hash; a level leaves less than half of distinct keys, so a shard needs some twenty.
MAX_LEVELS = 200


# ------------------------------------------------------------------ minimal perfect hash
def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_hash(keys: np.ndarray, gamma: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Levels of a minimal perfect hash over distinct 64-bit keys.

    At each level a key takes the slot of its hash if no other key wants it; the
    others go on to the next level. A key's number is the rank of its slot's bit
    over all levels. Returns the packed bits and the sizes of the levels. Equal
    keys would want the same slot at every level; they raise ``ValueError``.
    """
    bits, sizes, left = [], [], keys
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("the keys are not distinct")
        size = max(64, int(gamma * len(left)))
        slot = (_mix(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        bits.append(alone)
        sizes.append(size)
        left = left[~alone[slot]]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return np.packbits(flat), np.array(sizes, np.int64)


def lookup_hash(packed: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The number of each key; -1 for a key that falls through every level."""
    flat = np.unpackbits(packed, count=int(sizes.sum())).astype(bool)
    rank = np.cumsum(flat) - 1
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        slot = base + (_mix(keys[left], level + 1) % np.uint64(size)).astype(np.int64)
        hit = flat[slot]
        out[left[hit]] = rank[slot[hit]]
        left, base = left[~hit], base + int(size)
    return out


def _folded(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """One 64-bit key of a line's two hashes."""
    return h1.view(np.uint64) ^ _mix(h2.view(np.uint64), 0)


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2, lines = (pdf[c].to_numpy(np.int64) for c in ("h1", "h2", "n_lines"))
    first = np.where(pdf["first"] != pdf["last"], pdf["first"], -1).astype(np.int64)
    keys = _folded(h1, h2)
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    twins = times[at] > 1  # lines that only both hashes together tell apart: listed with them
    packed, sizes = build_hash(keys[~twins])
    at = lookup_hash(packed, sizes, keys[~twins])
    n = len(at)
    prints, counts, firsts = np.zeros(n, np.uint32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    prints[at], counts[at], firsts[at] = h2[~twins].view(np.uint64).astype(np.uint32), lines[~twins], first[~twins]
    has = firsts != -1
    listed = np.stack([h1[twins], h2[twins], lines[twins], first[twins]], axis=1)
    return pd.DataFrame({"shard": [pdf.shard.iloc[0]], "load": [int(lines.sum())], "bits": [packed.tobytes()],
                         "sizes": [sizes.tobytes()], "prints": [prints.tobytes()], "counts": [counts.tobytes()],
                         "has": [np.packbits(has).tobytes()], "firsts": [firsts[has].tobytes()], "twins": [listed.tobytes()]})


SHARD_SCHEMA = ("shard long, load long, bits binary, sizes binary, prints binary, counts binary, "
                "has binary, firsts binary, twins binary")


BLOBS = ("bits", "sizes", "prints", "counts", "has", "firsts", "twins")


class _Shard:
    """The arrays of one shard, as read by a probing task."""

    def __init__(self, row: dict[str, bytes]) -> None:
        self.packed, self.sizes = np.frombuffer(row["bits"], np.uint8), np.frombuffer(row["sizes"], np.int64)
        self.prints, self.counts = np.frombuffer(row["prints"], np.uint32), np.frombuffer(row["counts"], np.int64)
        has = np.unpackbits(np.frombuffer(row["has"], np.uint8), count=len(self.prints)).astype(bool)
        self.firsts = np.full(len(has), -1, np.int64)
        self.firsts[has] = np.frombuffer(row["firsts"], np.int64)
        self.twins = np.frombuffer(row["twins"], np.int64).reshape(-1, 4)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and first document of each line; 0 and -1 where the fingerprint says that the line isn't in."""
        at = lookup_hash(self.packed, self.sizes, _folded(h1, h2))
        known = at >= 0
        known[known] = self.prints[at[known]] == h2[known].view(np.uint64).astype(np.uint32)
        count, first = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        count[known], first[known] = self.counts[at[known]], self.firsts[at[known]]
        for a, b, lines, document in self.twins:
            mine = (h1 == a) & (h2 == b)
            count[mine], first[mine] = lines, document
        return count, first


def _probe_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its arrays first: holds one shard and one batch of lines at a time."""
    number, shard = None, None
    for batch in batches:
        ids = batch["shard"].to_numpy()
        head = np.asarray(batch["bits"].is_valid())
        cuts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | head[1:] | head[:-1]]) if len(ids) else []
        for a, b in zip(cuts, [*cuts[1:], len(ids)]):
            if head[a]:
                number, shard = ids[a], _Shard({c: batch[c][int(a)].as_py() for c in BLOBS})
                continue
            if number != ids[a]:
                raise ValueError(f"lines of shard {ids[a]} came before its arrays")
            part = batch.slice(a, b - a)
            count, first = shard.probe(part["h1"].to_numpy(), part["h2"].to_numpy())
            gone = (first != -1) & (first != part["d"].to_numpy())
            rows = part.select(["d", "t", "line"]).filter(pa.array(gone))
            yield rows.append_column("count", pa.array(count[gone]))


# ------------------------------------------------------------------ operator
def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(d, t, line, h1, h2) of every line whose key has ``min_chars`` code points or more."""
    lines = docs.select(id_key().alias("d"), text_key().alias("t"),
                        F.posexplode(F.split(text_of(), "\n")).alias("line", "raw"))
    keyed = lines.withColumn("key", ascii_lower(F.btrim("raw", F.lit(STRIPPED))))
    return (keyed.where(F.char_length("key") >= min_chars)
                 .select("d", "t", "line", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")))


def dropped_lines(docs: DataFrame, min_chars: int = 10, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(d, t, line, count): the lines that an earlier document holds, with the number of their copies."""
    hashes = stored(line_hashes(docs, min_chars), "line-hashes")
    keys = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_lines"), F.min("d").alias("first"),
                                          F.max("d").alias("last"))
    total = hashes.count()
    n = max(1, -(-total // shard_keys))
    shard = F.pmod(F.xxhash64("h1", "h2"), F.lit(n))
    shards = stored(keys.withColumn("shard", shard).groupBy("shard").applyInPandas(_build_shard, SHARD_SCHEMA),
                    "line-shards")
    # A shard with a common line gets many probes: its arrays go out in several copies and its probes are dealt over
    # them. Only shards above a thousandth of all lines count as hot, so there are a thousand of them at most.
    heavy = max(4 * total // n, total // 1000, 1)
    hot = F.broadcast(shards.where(F.col("load") > heavy)
                            .select("shard", F.ceil(F.col("load") / heavy).cast("int").alias("copies")))
    probes = (hashes.withColumn("shard", shard).join(hot, "shard", "left")
                    .withColumn("copy", F.pmod(F.xxhash64("d", "line"), F.coalesce("copies", F.lit(1))).cast("int")))
    heads = (shards.join(hot, "shard", "left")
                   .withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))))
    both = heads.select("shard", "copy", *BLOBS).unionByName(
        probes.select("shard", "copy", "d", "t", "line", "h1", "h2"), allowMissingColumns=True)
    dealt = (both.repartition("shard", "copy")
                 .sortWithinPartitions("shard", "copy", F.col("bits").isNull()))
    return dealt.mapInArrow(_probe_sorted, "d long, t long, line int, count long")


def dedup_lines(docs: DataFrame, min_chars: int = 10, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with its text cut to the lines that stay, and n_lines (before) and n_dropped (long) added."""
    d, t, gone = spare_names(docs.columns, "d", "t", "gone")
    found = (dropped_lines(docs, min_chars, shard_keys).groupBy(F.col("d").alias(d), F.col("t").alias(t))
             .agg(F.collect_set("line").alias(gone)))
    out = docs.withColumns({d: id_key(), t: text_key()}).join(found, [d, t], "left")
    lines = F.split(text_of(), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n"))
    names = without(docs.columns, ("n_lines", "n_dropped"))
    return out.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names],
                      F.size(lines).cast("long").alias("n_lines"),
                      F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"))
