"""Hard negatives by segment summary filtering, over integer vectors.

A vector is cut into segments, and each segment keeps its mean and its
deviation (the length of what is left after the mean). For two vectors the
inner product of a segment is ``length * mean * mean`` give or take
``deviation * deviation``; the sums over segments bound the score. Segments are
refined by halving (``LEVELS``): a level throws out the rows whose bounds show
that they can't be asked for, the rows left go to the next one, and the rows
left at the end are scored exactly, in whole numbers.

Rows are dealt out to blocks by hash, so neither a label nor a vector is a hot
spot; anchors go to every block, in groups of ``anchor_block``. A task holds one
block with one group of anchors and gives each anchor's best rows of the block,
which are ranked over all blocks afterwards.

1. Positives: the ``k_pos`` best rows of an anchor's label.
2. Negatives: for each positive the ``k_neg`` best rows of another label whose
   score lies between ``low`` and ``high`` hundredths of the positive's.

Defined results: rows with a null id, label or vector, or a vector with a null
component, take no part; rows that repeat in all three count once; rows under
an anchor's own id are no partners of it; an anchor's partners have vectors of
its length (vectors without components score 0); ties go to smaller ids, then
smaller labels; scores beyond 62 bits end the job with an error; empty tables
give no rows. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import stored

#: Numbers of segments, level by level.
LEVELS = (2, 8, 32)
#: Rows and anchors that meet in a task, at most (about, for rows).
BLOCK, ANCHOR_BLOCK = 1 << 14, 1 << 13
#: Rows of a block when there are few rows.
SMALL_BLOCK, MANY_BLOCKS = 512, 48


def whole_numbers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, in double precision; null for vectors with null or non-finite components."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def usable(rows: DataFrame) -> DataFrame:
    """The distinct rows of (id, label, v) that take part."""
    known = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    return rows.where(known & F.forall("v", lambda x: x.isNotNull())).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v").distinct()


# ------------------------------------------------------------------ bounds
class Summary:
    """Segments' means and deviations of a matrix, at each level."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.levels, self.largest = rows, [], float(np.abs(rows).max(initial=0))
        wide = rows.astype(np.float64)
        self.norms = np.sqrt((wide * wide).sum(axis=1))
        for n in LEVELS:
            edges = np.unique(np.linspace(0, rows.shape[1], min(n, max(rows.shape[1], 1)) + 1).astype(int))[:-1]
            if not rows.shape[1] or self.levels and len(edges) == self.levels[-1][0].shape[1]:
                continue
            size = np.diff(np.r_[edges, rows.shape[1]])
            mean = np.add.reduceat(wide, edges, axis=1) / size
            rest = wide - np.repeat(mean, size, axis=1)
            self.levels.append((mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, edges, axis=1))))

    def bounds(self, level: int, of: np.ndarray, other: Summary, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that rows ``of`` can have with row ``i`` of ``other``."""
        (mean, off), (m, o) = self.levels[level], other.levels[level]
        if len(of) < len(mean):
            mean, off = mean[of], off[of]
        mid, reach = mean @ m[i], off @ o[i]
        norm = self.norms[of] if len(of) < len(self.norms) else self.norms
        reach = reach + 1e-12 * other.norms[i] * norm + 1e-6  # the sums are rounded; scores of whole numbers are not
        return mid - reach, mid + reach

    def scores(self, of: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Exact scores of rows ``of``."""
        most = self.largest * float(np.abs(vector).max(initial=0)) * max(len(vector), 1)
        if most >= 2.0**62:
            raise ValueError("scores don't fit 62 bits")
        if most < 2.0**53:  # whole numbers that doubles add exactly
            return (self.rows[of].astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
        return self.rows[of] @ vector


def _best(ids: np.ndarray, labels: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((labels, ids, -scores))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def best_partners(block: Summary, other: Summary, i: int, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows among ``of`` that may be the ``k`` best for row ``i``, with their scores."""
    for level in range(len(block.levels)):
        if len(of) <= k:
            break
        low, high = block.bounds(level, of, other, i)
        likely = of[np.argpartition(-high, k)[:k]]  # their scores say more than bounds do
        of = of[high >= max(_kth(low, k), float(block.scores(likely, other.rows[i]).min()))]
    return of, block.scores(of, other.rows[i])


def band_partners(block: Summary, other: Summary, i: int, of: np.ndarray, bands: list[tuple[int, int]],
                  k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows among ``of`` that may be the ``k`` best of some band (lowest, highest score), with their scores."""
    for level in range(len(block.levels)):
        if len(of) <= k:
            break
        low, high = block.bounds(level, of, other, i)
        needed = np.zeros(len(of), bool)
        for floor, ceiling in bands:
            inside = low[(low >= floor) & (high <= ceiling)]  # these lie in the band for certain
            middle = np.where(low + high <= 2 * ceiling, low + high, -np.inf)
            likely = block.scores(of[np.argpartition(-middle, k)[:2 * k]], other.rows[i])
            cut = max(floor, _kth(inside, k), _kth(likely[(likely >= floor) & (likely <= ceiling)], k))
            needed |= (low <= ceiling) & (high >= cut)
        of = of[needed]
    scores = block.scores(of, other.rows[i])
    keep = np.zeros(len(of), bool)
    for floor, ceiling in bands:
        keep |= (scores >= floor) & (scores <= ceiling)
    return of[keep], scores[keep]


# ------------------------------------------------------------------ blocks
def _by_length(vectors: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of the vectors of each length."""
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.array([vectors[j] for j in at], np.int64).reshape(len(at), size)


def _meet(rows: pd.DataFrame, anchors: pd.DataFrame) -> Iterator[tuple[int, Summary, Summary, int, np.ndarray, np.ndarray]]:
    """Each anchor with the rows of its length: (anchor's place, block, anchors, row among them, ids, labels)."""
    blocks = {n: (at, Summary(m)) for n, at, m in _by_length(list(rows.v))}
    ids, labels = rows.id.to_numpy(np.int64), rows.label.to_numpy(np.int64)
    for n, at, m in _by_length(list(anchors.v)):
        if n in blocks:
            mine, block = blocks[n]
            other = Summary(m)
            for i, place in enumerate(at):
                yield int(place), block, other, i, ids[mine], labels[mine]


def _positives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for place, block, other, i, ids, labels in _meet(rows, anchors):
        a = anchors.iloc[place]
        of, scores = best_partners(block, other, i, np.flatnonzero((labels == a.label) & (ids != a.id)), k)
        out += [(a.aid, ids[of[j]], scores[j]) for j in _best(ids[of], labels[of], scores, k)]
    return pd.DataFrame(out, columns=["aid", "id", "score"])


def _negatives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    out = []
    for place, block, other, i, ids, labels in _meet(rows, anchors):
        a = anchors.iloc[place]
        bands = sorted({(-(-low * int(s) // 100), high * int(s) // 100) for s in a.scores})
        of, scores = band_partners(block, other, i, np.flatnonzero((labels != a.label) & (ids != a.id)), bands, k)
        taken = set()
        for floor, ceiling in bands:
            inside = np.flatnonzero((scores >= floor) & (scores <= ceiling))
            taken.update(inside[_best(ids[of[inside]], labels[of[inside]], scores[inside], k)].tolist())
        out += [(a.aid, ids[of[j]], labels[of[j]], scores[j]) for j in sorted(taken)]
    return pd.DataFrame(out, columns=["aid", "id", "label", "score"])


def _in_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, fn, schema: str) -> DataFrame:
    """``fn`` of each block of rows with each group of anchors."""
    dealt = (rows.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    sent = (anchors.withColumn("part", F.pmod(F.xxhash64("aid"), F.lit(groups)).cast("int"))
                   .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    return dealt.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInPandas(fn, schema)


def mine(rows: DataFrame, is_anchor: Column, k_pos: int = 5, k_neg: int = 10, low: int = 30, high: int = 90,
         block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """Hard negatives of (id, label, v array<long>) for the rows with ``is_anchor``.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    negatives of a positive p satisfy ``low * p <= 100 * score <= high * p``.
    """
    rows = stored(usable(rows), "negatives-rows")
    anchors = stored(rows.where(is_anchor).withColumn("aid", F.concat_ws("-", "id", F.hex(F.xxhash64("label", "v"))))
                         .select("aid", "id", "label", "v"), "negatives-anchors")
    n, n_anchors = rows.count(), anchors.count()
    blocks = max(math.ceil(n / block), min(MANY_BLOCKS, math.ceil(n / SMALL_BLOCK)), 1)
    groups = max(1, math.ceil(n_anchors / anchor_block))

    found = _in_blocks(rows, anchors, blocks, groups, lambda a, b: _positives(a, b, k_pos), "aid string, id long, score long")
    order = Window.partitionBy("aid").orderBy(F.desc("score"), "id")
    positives = stored(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k_pos), "positives")

    wanted = anchors.join(positives.groupBy("aid").agg(F.collect_list("score").alias("scores")), "aid")
    near = _in_blocks(rows, wanted, blocks, groups, lambda a, b: _negatives(a, b, k_neg, low, high),
                      "aid string, id long, label long, score long")
    p, q, who = positives.alias("p"), near.alias("q"), anchors.select("aid", F.col("id").alias("anchor_id"))
    pairs = p.join(q, F.col("p.aid") == F.col("q.aid")).where(
        (F.col("q.score") * 100 >= F.col("p.score") * low) & (F.col("q.score") * 100 <= F.col("p.score") * high))
    best = Window.partitionBy("p.aid", "p.place").orderBy(F.desc("q.score"), "q.id", "q.label")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k_neg).select(
        F.col("p.aid").alias("aid"), F.col("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("q.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("q.score").alias("negative_score"))
    return ranked.join(who, "aid").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
