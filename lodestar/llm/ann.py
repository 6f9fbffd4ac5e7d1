"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half is quantised by a
codebook of its own, so a pair of centroids is a cell. The codebooks are fitted
(k-means, one Spark group per half) on ``MAX_FIT`` vectors at most, those whose
ids hash lowest; every vector is indexed. A query visits the pairs of centroids
in the order of their summed distance, taken from a heap over the two sorted
lists of distances, until the visited cells hold a share of all vectors. That
share is calibrated: ``PROBES`` sampled vectors are searched exactly, and the
share at which ``TARGET`` of their neighbours' cells are visited is used. All
entries of visited cells are reranked by their exact cosine (double precision,
original vectors).

Cells of more than ``BLOCK`` entries are cut into blocks by the hash of the id,
and queries go to every block of a cell; a task holds one block and one batch
of queries. Equal vectors in any number are therefore no hot spot.

Defined results: an id or vector that is null, of another length than most, zero, or with null or
non-finite components takes no part; a row repeated with the same vector counts
once; the neighbours of a query are rows of other ids; ties go to smaller ids;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import stored

MAX_FIT, PROBES, TARGET = 20_000, 200, 0.96
#: Vectors in a cell, about, on which the number of centroids is set.
CELL, MAX_CENTROIDS = 256, 256
BLOCK = 4096
ROUNDS = 12


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>): the distinct rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if length is None:
        return rows
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where((F.size("v") == length["n"]) & (F.size("v") > 0)).where(finite)
                .where(F.exists("v", lambda x: x != 0)).distinct())


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one; changes no digit of a cosine."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])


def _unit(m: np.ndarray) -> np.ndarray:
    m = _scaled(m)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def halves(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = max(1, unit.shape[1] // 2)
    return unit[:, :cut], unit[:, cut:] if unit.shape[1] > 1 else unit[:, :0]


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(1)[None, :]


def fit_codebook(rows: np.ndarray, k: int) -> np.ndarray:
    """k-means from evenly spaced rows in lexicographic order."""
    rows = np.unique(rows, axis=0)
    centroids = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _distances(rows, centroids).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, rows)
        some = counts > 0
        centroids[some] = sums[some] / counts[some, None]
    return centroids


class MultiIndex:
    """Codebooks, number of vectors per cell, and the share of vectors that a query visits."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], counts: dict[int, int], share: float = 1.0):
        self.books, self.counts, self.share = books, counts, share
        self.total = sum(counts.values())

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = (_distances(h, book).argmin(axis=1) for h, book in zip(halves(unit), self.books))
        return a * len(self.books[1]) + b

    def traverse(self, unit: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
        """Non-empty cells of one query in order of summed distance, with the vectors visited before each."""
        lists = [_distances(h[None, :], book)[0] for h, book in zip((x[0] for x in halves(unit[None, :])), self.books)]
        order = [np.argsort(d, kind="stable") for d in lists]
        near = [d[o] for d, o in zip(lists, order)]
        heap, width = [(near[0][0] + near[1][0], 0, 0)], len(self.books[1])
        seen = 0
        while heap and seen < least:
            _, i, j = heapq.heappop(heap)
            cell = int(order[0][i]) * width + int(order[1][j])
            n = self.counts.get(cell, 0)
            if n:
                yield cell, seen
                seen += n
            if j + 1 < len(near[1]):
                heapq.heappush(heap, (near[0][i] + near[1][j + 1], i, j + 1))
            if j == 0 and i + 1 < len(near[0]):
                heapq.heappush(heap, (near[0][i + 1] + near[1][0], i + 1, 0))


def _books(sample: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        unit = _unit(np.array(pdf.v.tolist(), np.float64))
        book = fit_codebook(halves(unit)[int(pdf.half.iloc[0])], k)
        return pd.DataFrame({"half": [pdf.half.iloc[0]], "n": [len(book)], "book": [book.ravel().tolist()]})

    both = sample.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = both.groupBy("half").applyInPandas(fit, "half int, n int, book array<double>").collect()
    found = {r["half"]: np.array(r["book"], np.float64).reshape(r["n"], -1) for r in rows}
    return found[0], found[1]


def build_index(vectors: DataFrame) -> tuple[MultiIndex, DataFrame] | None:
    """The index of (id, v) and the stored entries (cell, id, v); None for an empty table."""
    total = vectors.count()
    if not total:
        return None
    k = int(min(MAX_CENTROIDS, max(2, 2 ** round(np.log2(max(1.0, (total / CELL) ** 0.5))))))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(MAX_FIT)
    books = _books(sample, k)
    blank = MultiIndex(books, {})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = blank.cells(_unit(_matrix(batch["v"])))
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cells.astype(np.int64)), "id": batch["id"], "v": batch["v"]})

    entries = stored(vectors.mapInArrow(assign, "cell long, id long, v array<double>"), "ann-entries")
    # one row per pair of centroids: MAX_CENTROIDS squared at most
    counts = {r["cell"]: r["n"] for r in entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    return MultiIndex(books, counts), entries


def _top(ids: np.ndarray, m: np.ndarray, own: np.ndarray, asked: np.ndarray,
         k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each asked vector its k best rows, by cosine, then id, never of its own id: (number, places, cosines).

    A matrix product finds the candidates; rows within its rounding error of the k-th are summed again one by one, so
    that equal vectors have equal cosines whatever batch they came in.
    """
    m, asked = _scaled(m), _scaled(asked)
    lengths, length = np.sqrt((m * m).sum(axis=1)), np.sqrt((asked * asked).sum(axis=1))
    rough = (asked @ m.T) / lengths[None, :] / length[:, None]
    rough[ids[None, :] == own[:, None]] = -np.inf
    for r, row in enumerate(rough):
        cut = np.partition(row, len(row) - k)[len(row) - k] - 1e-11 if len(row) > k else -np.inf
        at = np.flatnonzero((row >= cut) & (row > -np.inf))
        cosines = (m[at] * asked[r]).sum(axis=1) / (lengths[at] * length[r])
        best = np.lexsort((ids[at], -cosines))[:k]
        yield r, at[best], cosines[best]


def _rerank(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: its entries, then its queries. Holds one block."""
    key, ids, m, held = None, None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch["cell"].to_numpy(), batch["part"].to_numpy(), batch["kind"].to_numpy()))
        cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
        for a, b in zip(cuts, [*cuts[1:], len(keys)]):
            rows, now = batch.slice(a, b - a), keys[a]
            if now[2] == 0:
                if key != now[:2]:
                    key, held = now[:2], []
                held.append((rows["id"].to_numpy(), _matrix(rows["v"])))
                ids = None
                continue
            if key != now[:2]:
                continue  # a block without entries
            if ids is None:
                ids, m = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            own = rows["id"].to_numpy()
            found = [(own[r], ids[at], score) for r, at, score in _top(ids, m, own, _matrix(rows["v"]), k)]
            n = [len(f[1]) for f in found]
            yield pa.RecordBatch.from_pydict({
                "query": pa.array(np.repeat([f[0] for f in found], n).astype(np.int64)),
                "id": pa.array(np.concatenate([f[1] for f in found])), "score": pa.array(np.concatenate([f[2] for f in found]))})


def nearest(entries: DataFrame, asked: DataFrame, blocks: dict[int, int], k: int) -> DataFrame:
    """(query, id, score, rank) of the k best entries in the cells that each query asks: ``asked`` is (cell, id, v)."""
    spark = entries.sparkSession
    many = {c: n for c, n in blocks.items() if n > 1}
    if many:
        table = F.broadcast(spark.createDataFrame(list(many.items()), "cell long, parts int"))  # of the cells' number at most
        entries, asked = entries.join(table, "cell", "left"), asked.join(table, "cell", "left")
    else:
        entries, asked = (x.withColumn("parts", F.lit(1)) for x in (entries, asked))
    parts = F.coalesce("parts", F.lit(1))
    dealt = entries.select("cell", F.pmod(F.xxhash64("id", F.lit("part")), parts).cast("int").alias("part"),
                           F.lit(0).alias("kind"), "id", "v")
    asks = asked.select("cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(1).alias("kind"), "id", "v")
    rows = dealt.unionByName(asks).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
    found = rows.mapInArrow(lambda it: _rerank(it, k), "query long, id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def calibrate(index: MultiIndex, entries: DataFrame, k: int) -> float:
    """The share of vectors to visit so that ``TARGET`` of the sampled vectors' exact neighbours are met."""
    probes = [(r["id"], np.array(r["v"])) for r in
              entries.orderBy(F.xxhash64("id", F.lit("probe")), "id").limit(PROBES).select("id", "v").collect()]
    own, asked = np.array([p[0] for p in probes]), np.array([p[1] for p in probes])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch["id"].to_numpy()
                for r, at, score in _top(ids, _matrix(batch["v"]), own, asked, k):
                    yield pa.RecordBatch.from_pydict({"query": pa.array(np.full(len(at), r)), "id": pa.array(ids[at]),
                                                      "cell": pa.array(batch["cell"].to_numpy()[at]), "score": pa.array(score)})

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true = (entries.mapInArrow(exact, "query long, id long, cell long, score double")
                   .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).select("query", "cell").collect())
    shares = []
    for q in range(len(probes)):
        wanted = [t["cell"] for t in true if t["query"] == q]
        visited = {c: seen + index.counts[c] for c, seen in index.traverse(_unit(asked[q:q + 1])[0], index.total + 1)}
        shares += [visited[c] / index.total for c in wanted]
    return float(np.quantile(shares, TARGET)) if shares else 1.0


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query, id, score, rank): for each query (id, v) its k nearest rows of ``vectors`` found."""
    built = build_index(vectors)
    if built is None:
        return queries.sparkSession.createDataFrame([], "query long, id long, score double, rank int")
    index, entries = built
    index.share = calibrate(index, entries, k)
    least = max(int(np.ceil(index.share * index.total)), 50 * k)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_matrix(batch["v"]))
                cells = [[c for c, _ in index.traverse(u, least)] for u in unit]
                yield pa.RecordBatch.from_pydict({"cells": pa.array(cells, pa.list_(pa.int64())), "id": batch["id"], "v": batch["v"]})

    asked = queries.mapInArrow(ask, "cells array<long>, id long, v array<double>")
    asked = asked.select(F.explode("cells").alias("cell"), "id", "v")
    blocks = {c: -(-n // BLOCK) for c, n in index.counts.items()}
    return nearest(entries, asked, blocks, k)
