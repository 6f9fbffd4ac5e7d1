"""Boosted trees with second-order gradients, and their exact additive explanations.

Fitting: features become bins at quantiles of mergeable sketches (or at their
distinct values when these are few), written to two bytes per value. Rows are
dealt evenly to parts and kept as runs of packed bytes, so a pass hands Python
a few buffers instead of rows. A round grows one tree level by level. Each level is one aggregation: tasks add
their rows' gradients and curvatures up by (node, feature, bin), Spark adds the
tasks up, and running sums over the bins give every cut's gain. Only the best
cut of each node reaches the driver.

Sums are whole numbers (fixed point), so neither partitions nor the number of
cores change a tree. Column samples come from the seed, row samples from a hash
of the row's id.

Explanations: for a leaf reached through d different features the game
``v * prod(one_j or zero_j)`` has a closed form. ``zero_j`` is the share of the
training weight that follows the path at feature j's cuts, ``one_j`` whether the
row does; the polynomial ``prod(zero_j + one_j t)`` holds the sums over subsets
of every size. Contributions, the constant and interactions are sums over
leaves, in Arrow batches and without a background sample.

Defined results: rows with a null label (or NaN) take no part in a fit; a null
or NaN feature goes the way that gained most while training (left when nothing
was missing); an empty training table raises ``ValueError``; ties between cuts
go to the first feature, the smallest threshold, missing values left.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Histogram cells up to which a task adds up in arrays; beyond, each batch gives its own sparse sums.
DENSE_CELLS = 1 << 22

#: Rows of a part of the training table, at most on average.
PART_ROWS = 500_000

#: The packed training table: a row is a run of rows, each column their values one after the other.
PACKED = "y binary, h binary, margin binary, bins binary"


@dataclass(frozen=True)
class NewtonParams:
    """``objective``: ``binary`` (logistic loss, labels 0 and 1) or ``regression`` (squared error).

    ``reg_lambda`` and ``reg_alpha`` shrink leaf weights, ``gamma`` is the least gain of a cut, ``min_child_weight``
    the least curvature of a side. ``colsample_*`` and ``subsample`` are shares of columns and rows.
    """

    objective: str = "binary"
    rounds: int = 10
    max_depth: int = 6
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    max_bins: int = 256
    seed: int = 0
    checkpoint_every: int = 10


@dataclass
class Tree:
    """Node i: ``feature`` (-1 for a leaf), ``threshold`` (at most goes left), children, leaf ``value``, rows, curvature."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, rows: int, cover: float, value: float) -> int:
        for name, v in (("feature", -1), ("threshold", math.nan), ("missing_left", True), ("left", -1), ("right", -1),
                        ("value", value), ("gain", 0.0), ("rows", rows), ("cover", cover)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of values ends in."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, by_default = np.array(self.left), np.array(self.right), np.array(self.missing_left)
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            v = x[inner, feature[node]]
            goes = np.where(np.isnan(v), by_default[node], v <= threshold[node])
            at[inner] = np.where(goes, left[node], right[node])


# ------------------------------------------------------------------ bins
def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Ascending cut values per feature: all distinct values when at most ``max_bins``, else quantiles of a sketch."""
    shares = [i / max_bins for i in range(1, max_bins)]
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features}
    seen = df.agg(*(F.percentile_approx(value[f], shares, 10_000).alias(f"q{i}") for i, f in enumerate(features)),
                  *(F.approx_count_distinct(value[f]).alias(f"n{i}") for i, f in enumerate(features))).first()
    few = [i for i in range(len(features)) if seen[f"n{i}"] <= max_bins]
    listed = df.agg(*(F.collect_set(value[features[i]]).alias(f"v{i}") for i in few)).first() if few else {}
    out = []
    for i in range(len(features)):
        values = listed[f"v{i}"] if i in few and len(listed[f"v{i}"]) <= max_bins else seen[f"q{i}"] or []
        out.append(np.unique(np.array(values, np.float64)))
    return out


def _values(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns as doubles, null as NaN."""
    return np.column_stack([batch[c].to_numpy(zero_copy_only=False).astype(np.float64) for c in names]) if names \
        else np.zeros((batch.num_rows, 0))


class Run(NamedTuple):
    """Labels, hashes, margins and bins (rows, features) of a run of rows."""

    y: np.ndarray
    h: np.ndarray
    margin: np.ndarray
    bins: np.ndarray

    def packed(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({name: pa.array([v.tobytes()], pa.binary()) for name, v in self._asdict().items()})


def _runs(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[Run]:
    for batch in batches:
        for i in range(batch.num_rows):
            y, h, margin, bins = (batch[name][i].as_buffer() for name in Run._fields)
            yield Run(np.frombuffer(y), np.frombuffer(h, np.int64), np.frombuffer(margin), np.frombuffer(bins, np.int16).reshape(-1, n_features))


def _binned(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray], margin: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = np.zeros((batch.num_rows, len(edges)), np.int16)
        for i, e in enumerate(edges):
            x = batch[f"x{i}"].to_numpy(zero_copy_only=False).astype(np.float64)
            bins[:, i] = np.where(np.isnan(x), 0, np.searchsorted(e, x, "left") + 1)
        yield Run(np.asarray(batch["y"], np.float64), np.asarray(batch["h"], np.int64), np.full(batch.num_rows, margin), bins).packed()


# ------------------------------------------------------------------ one level
def _gradients(y: np.ndarray, margin: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    if objective == "regression":
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    return p - y, np.maximum(p * (1 - p), 1e-16)


def _walk(bins: np.ndarray, tree: Tree, cut: Sequence[int]) -> np.ndarray:
    """The node that each binned row has come to; ``cut`` is the last bin that goes left."""
    feature, last = np.array(tree.feature), np.array(cut)
    left, right, by_default = np.array(tree.left), np.array(tree.right), np.array(tree.missing_left)
    at = np.zeros(len(bins), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return at
        node = at[inner]
        b = bins[inner, feature[node]]
        at[inner] = np.where(np.where(b == 0, by_default[node], b <= last[node]), left[node], right[node])


def _histograms(batches: Iterator[pa.RecordBatch], tree: Tree, cut: list[int], open_nodes: list[int], columns: list[int],
                n_features: int, n_bins: int, scale: tuple[float, float], params: NewtonParams, round_: int) -> Iterator[pa.RecordBatch]:
    slot = np.full(len(tree.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))
    cells = len(open_nodes) * len(columns) * n_bins
    dense = cells <= DENSE_CELLS
    totals = [np.zeros(cells, np.int64) for _ in range(3)] if dense else None

    def rows(code: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
        node, rest = np.divmod(code, len(columns) * n_bins)
        f, b = np.divmod(rest, n_bins)
        return pa.RecordBatch.from_pydict({
            "node": pa.array(np.array(open_nodes)[node], pa.int32()), "feature": pa.array(np.array(columns)[f], pa.int32()),
            "bin": pa.array(b, pa.int32()), "n": pa.array(sums[0]), "g": pa.array(sums[1]), "h": pa.array(sums[2])})

    for run in _runs(batches, n_features):
        here = slot[_walk(run.bins, tree, cut)]
        used = here >= 0
        if params.subsample < 1:
            used &= _drawn(run.h, params, round_)
        g, h = _gradients(run.y, run.margin, params.objective)
        g, h = (np.rint(v[used] * s).astype(np.int64) for v, s in zip((g, h), scale))
        code = ((here[used, None] * len(columns) + np.arange(len(columns))) * n_bins + run.bins[used][:, columns]).ravel()
        one, gs, hs = np.ones(len(code), np.int64), np.repeat(g, len(columns)), np.repeat(h, len(columns))
        if dense and cells <= len(code):  # np.bincount is the faster one, but makes all cells
            totals[0] += np.bincount(code, minlength=cells)
            totals[1] += _whole_sums(code, gs, cells)
            totals[2] += _whole_sums(code, hs, cells)
        elif dense:
            for total, v in zip(totals, (one, gs, hs)):
                np.add.at(total, code, v)
        elif len(code):
            keys, at = np.unique(code, return_inverse=True)
            sums = [np.zeros(len(keys), np.int64) for _ in range(3)]
            for total, v in zip(sums, (one, gs, hs)):
                np.add.at(total, at, v)
            yield rows(keys, sums)
    if dense and (some := np.flatnonzero(totals[0])).size:
        yield rows(some, [t[some] for t in totals])


def _whole_sums(code: np.ndarray, values: np.ndarray, cells: int) -> np.ndarray:
    """Exact sums of whole numbers by code: doubles hold the sums of each half of the bits."""
    low = np.bincount(code, (values & ((1 << 30) - 1)).astype(np.float64), cells)
    high = np.bincount(code, (values >> 30).astype(np.float64), cells)
    return (high.astype(np.int64) << 30) + low.astype(np.int64)


def _drawn(hashes: np.ndarray, params: NewtonParams, round_: int) -> np.ndarray:
    """The rows of a round's sample: a remix of the id's hash, the same on any machine."""
    x = hashes.view(np.uint64) ^ np.uint64((params.seed * 1_000_003 + round_ + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) / 2.0**64 < params.subsample


def _shrunk(g: Column, alpha: float) -> Column:
    """``g`` moved towards zero by ``alpha``."""
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(alpha), F.lit(0.0))


def best_cuts(histogram: DataFrame, scale: tuple[float, float], params: NewtonParams) -> DataFrame:
    """The best cut of each node of (node, feature, bin, n, g, h), with the totals of its node and its left side; ``gain`` is null without one.

    Bin 0 holds missing values, which are tried on both sides of every cut.
    """
    score = lambda g, h: _shrunk(g, params.reg_alpha) * _shrunk(g, params.reg_alpha) / (h + params.reg_lambda)
    each = Window.partitionBy("node", "feature")
    along = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = histogram.withColumns({
        **{f"{c}_all": F.sum(c).over(each) for c in "ngh"},
        **{f"{c}_miss": F.sum(F.when(F.col("bin") == 0, F.col(c)).otherwise(0)).over(each) for c in "ngh"},
        **{f"{c}_to": F.sum(F.when(F.col("bin") > 0, F.col(c)).otherwise(0)).over(along) for c in "ngh"}})
    sides = sums.withColumn("miss_left", F.explode(F.array(F.lit(True), F.lit(False))))
    put = {c: F.col(f"{c}_to") + F.when(F.col("miss_left"), F.col(f"{c}_miss")).otherwise(0) for c in "ngh"}
    gl, hl = put["g"] / scale[0], put["h"] / scale[1]
    ga, ha = F.col("g_all") / scale[0], F.col("h_all") / scale[1]
    gain = (score(gl, hl) + score(ga - gl, ha - hl) - score(ga, ha)) / 2 - params.gamma
    valid = ((F.col("bin") > 0) & (put["n"] > 0) & (put["n"] < F.col("n_all"))
             & (hl >= params.min_child_weight) & (ha - hl >= params.min_child_weight) & (gain > 1e-12))
    first = F.min_by(F.struct("feature", "bin", "miss_left", "gain", "n_left", "g_left", "h_left"),
                     F.struct(F.col("gain").isNull(), -F.col("gain"), "feature", "bin", ~F.col("miss_left")))
    rated = sides.select("node", "feature", "bin", "miss_left", "n_all", "g_all", "h_all", F.when(valid, gain).alias("gain"),
                         *(put[c].alias(f"{c}_left") for c in "ngh"))
    return rated.groupBy("node").agg(F.first("n_all").alias("n"), F.first("g_all").alias("g"), F.first("h_all").alias("h"),
                                     first.alias("best")).select("node", "n", "g", "h", "best.*")


# ------------------------------------------------------------------ model
class NewtonModel:
    """``base`` plus the sum of the trees' leaf values is a row's margin."""

    def __init__(self, params: NewtonParams, features: Sequence[str], base: float, trees: Sequence[Tree]):
        self.params, self.features, self.base, self.trees = params, list(features), base, list(trees)

    # --- scoring
    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((np.array(t.value)[t.leaf_of(x)] for t in self.trees), np.zeros(len(x)))

    def transform(self, df: DataFrame, keep: Sequence[str], margin: str = "margin", prediction: str = "prediction") -> DataFrame:
        """Columns ``keep`` with the margin and the prediction (the probability for ``binary``)."""
        def out(x: np.ndarray) -> dict[str, np.ndarray]:
            m = self.margins(x)
            return {margin: m, prediction: 1 / (1 + np.exp(-np.clip(m, -500, 500))) if self.params.objective == "binary" else m}
        return _per_row(df, keep, self.features, out, {margin: "double", prediction: "double"})

    # --- explanations
    def contributions(self, df: DataFrame, keep: Sequence[str], prefix: str = "c_", bias: str = "bias") -> DataFrame:
        """Columns ``keep`` with ``c_<feature>`` and ``bias``; together they are the margin."""
        leaves, constant = self._leaves()
        names = [f"{prefix}{f}" for f in self.features]

        def out(x: np.ndarray) -> dict[str, np.ndarray]:
            return {**dict(zip(names, shapley(leaves, x).T)), bias: np.full(len(x), constant)}
        return _per_row(df, keep, self.features, out, {c: "double" for c in [*names, bias]})

    def interactions(self, df: DataFrame, id_col: str) -> DataFrame:
        """(id, feature_i, feature_j, value) for all pairs of features that some tree uses; rows add up to the contributions.

        A pair's effect is split between (i, j) and (j, i); the diagonal is what is left of a feature's own. The
        constant has the row (``bias``, ``bias``), so a row's values add up to its margin.
        """
        leaves, constant = self._leaves()
        used = sorted({int(f) for t in self.trees for f in t.feature if f >= 0})
        pairs = [(i, j) for i in used for j in used]

        def out(x: np.ndarray) -> dict[str, np.ndarray]:
            m = interaction_values(leaves, x)
            return {"values": np.column_stack([*(m[:, i, j] for i, j in pairs), np.full(len(x), constant)])}
        wide = _per_row(df, [id_col], self.features, out, {"values": "array<double>"})
        names = [(self.features[i], self.features[j]) for i, j in pairs] + [("bias", "bias")]
        label = F.array(*(F.struct(F.lit(a).alias("feature_i"), F.lit(b).alias("feature_j")) for a, b in names))
        long = wide.select(id_col, F.posexplode("values").alias("at", "value"))
        return long.withColumn("pair", F.get(label, F.col("at"))).select(id_col, "pair.feature_i", "pair.feature_j", "value")

    def _leaves(self) -> tuple[list[Leaf], float]:
        leaves = [leaf for t in self.trees for leaf in leaf_games(t)]
        return leaves, self.base + sum(float(np.prod(leaf.zero)) * leaf.value for leaf in leaves)

    # --- storing
    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table: tree, node, feature, threshold, missing_left, left, right, value, gain, rows, cover."""
        rows = [(k, i, self.features[t.feature[i]] if t.feature[i] >= 0 else None,
                 t.threshold[i] if t.feature[i] >= 0 else None, bool(t.missing_left[i]), t.left[i], t.right[i],
                 float(t.value[i]), float(t.gain[i]), int(t.rows[i]), float(t.cover[i]))
                for k, t in enumerate(self.trees) for i in range(len(t.feature))]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, missing_left boolean, "
                                           "left int, right int, value double, gain double, rows long, cover double")

    def save(self, spark: SparkSession, path: str) -> None:
        """The node table as Parquet, parameters beside it."""
        about = json.dumps({"params": asdict(self.params), "features": self.features, "base": self.base, "trees": len(self.trees)})
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NewtonModel:
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        trees = [Tree() for _ in range(about["trees"])]
        place = {f: i for i, f in enumerate(about["features"])}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # a model's nodes
            t = trees[r["tree"]]
            t.add(r["rows"], r["cover"], r["value"])
            t.feature[-1], t.threshold[-1] = place.get(r["feature"], -1), math.nan if r["threshold"] is None else r["threshold"]
            t.missing_left[-1], t.left[-1], t.right[-1], t.gain[-1] = r["missing_left"], r["left"], r["right"], r["gain"]
        return NewtonModel(NewtonParams(**about["params"]), about["features"], about["base"], trees)


def _per_row(df: DataFrame, keep: Sequence[str], features: Sequence[str], fn, kinds: Mapping[str, str]) -> DataFrame:
    """Columns ``keep`` and what ``fn`` makes of the rows' feature values."""
    if clash := set(keep) & set(kinds):
        raise ValueError(f"kept columns {sorted(clash)} have the names of results")
    inner = [f"k{i}" for i in range(len(keep))]
    xs = [f"x{i}" for i in range(len(features))]
    schema = T.StructType([*(T.StructField(k, df.schema[c].dataType) for k, c in zip(inner, keep)),
                           *(T.StructField(f"r{i}", T._parse_datatype_string(kind)) for i, kind in enumerate(kinds.values()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = fn(_values(batch, xs))
            cols = {k: batch[k] for k in inner}
            cols |= {f"r{i}": pa.array(list(v), pa.list_(pa.float64())) if v.ndim > 1 else pa.array(v) for i, v in enumerate(got.values())}
            yield pa.RecordBatch.from_pydict(cols)

    rows = df.select(*(F.col(c).alias(k) for c, k in zip(keep, inner)), *(F.col(f).cast("double").alias(x) for f, x in zip(features, xs)))
    return rows.mapInArrow(run, schema).toDF(*keep, *kinds)


# ------------------------------------------------------------------ fitting
def fit_newton(df: DataFrame, features: Sequence[str], label: str, params: NewtonParams = NewtonParams(),
               id_col: str | None = None, edges: Mapping[str, Sequence[float]] | None = None) -> NewtonModel:
    """Fit boosted trees. ``id_col`` is needed for ``subsample`` below 1; ``edges`` gives cut values instead of quantiles."""
    if params.objective not in ("binary", "regression"):
        raise ValueError(f"unknown objective {params.objective!r}")
    if params.subsample < 1 and id_col is None:
        raise ValueError("a row sample needs id_col")
    features = list(features)
    y = F.nanvl(F.col(label).cast("double"), F.lit(None).cast("double"))
    rows = df.where(y.isNotNull())
    key = F.xxhash64(F.col(id_col)) if id_col else F.lit(0).cast("long")
    xs = [f"x{i}" for i in range(len(features))]
    # counted, sketched and binned from one reading of the source
    rows = rows.select(y.alias("y"), key.alias("h"), *(F.col(f).cast("double").alias(x) for f, x in zip(features, xs))).persist(StorageLevel.MEMORY_AND_DISK)
    state = None
    try:
        start = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).first()
        if not start["n"]:
            raise ValueError("no rows with a label")
        given = dict(edges or {})
        found = iter(bin_edges(rows, [x for f, x in zip(features, xs) if f not in given], params.max_bins) if len(given) < len(features) else [])
        cuts = [np.unique(np.array(given[f], np.float64)) if f in given else next(found) for f in features]
        base = float(start["mean"])
        if params.objective == "binary":
            share = min(max(base, 1e-9), 1 - 1e-9)
            base = math.log(share / (1 - share))
        parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-start["n"] // PART_ROWS))
        state = rows.repartition(parts).mapInArrow(lambda it: _binned(it, cuts, base), PACKED).persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
    finally:
        rows.unpersist()
    model = NewtonModel(params, features, base, [])
    n_bins = max((len(c) for c in cuts), default=0) + 2
    rng = np.random.default_rng(params.seed)
    before = None
    try:
        for k in range(params.rounds):
            tree, cut = _grow(state, cuts, n_bins, int(start["n"]), params, k, rng)
            model.trees.append(tree)
            if k + 1 == params.rounds:
                break
            after = _with_tree(state, tree, cut, len(features))
            if (k + 1) % params.checkpoint_every == 0:
                after = after.checkpoint()  # short lineage: a lost executor recomputes a few rounds at most
            if before is not None:
                before.unpersist()
            before, state = state, after.persist(StorageLevel.MEMORY_AND_DISK)  # filled by the next level's job
    finally:
        state.unpersist()
        if before is not None:
            before.unpersist()
    return model


def _with_tree(state: DataFrame, tree: Tree, cut: list[int], n_features: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(tree.value)
        for rows in _runs(batches, n_features):
            yield rows._replace(margin=rows.margin + value[_walk(rows.bins, tree, cut)]).packed()
    return state.mapInArrow(run, PACKED)


def _scales(state: DataFrame, n: int, params: NewtonParams, p: int) -> tuple[float, float]:
    """Powers of two for fixed-point sums of n gradients and curvatures: as fine as 62 bits allow, 2**-40 at most."""
    room = 61 - math.ceil(math.log2(max(n, 2)))
    most = 1.0
    if params.objective == "regression":
        far = lambda it: (pa.RecordBatch.from_pydict({"far": pa.array([np.abs(r.margin - r.y).max()])}) for r in _runs(it, p))
        most = max(state.mapInArrow(far, "far double").agg(F.max("far")).first()[0] or 1.0, 1e-300)
    return 2.0 ** min(room - math.ceil(math.log2(most)), 40), 2.0 ** min(room, 40)


def _grow(state: DataFrame, cuts: list[np.ndarray], n_bins: int, n: int, params: NewtonParams, round_: int,
          rng: np.random.Generator) -> tuple[Tree, list[int]]:
    p = len(cuts)
    draw = lambda pool, share: sorted(rng.choice(pool, max(1, round(share * len(pool))), replace=False).tolist()) \
        if share < 1 else list(pool)
    columns = draw(range(p), params.colsample_bytree)
    scale = _scales(state, n, params, p)
    tree, cut = Tree(), [0]
    totals: list[tuple[int, int, int]] = []  # rows, gradients and curvatures of each node, the latter in fixed point

    def add(sums: tuple[int, int, int]) -> int:
        g, h = sums[1] / scale[0], sums[2] / scale[1]
        shrunk = math.copysign(max(abs(g) - params.reg_alpha, 0.0), g)
        totals.append(sums)
        return tree.add(sums[0], h, -params.learning_rate * shrunk / (h + params.reg_lambda) + 0.0)  # no minus zero

    tree.add(n, 0.0, 0.0)
    open_nodes = [0]
    for _ in range(max(params.max_depth, 1)):
        mine = draw(columns, params.colsample_bylevel)
        args = (tree, list(cut), list(open_nodes), mine, p, n_bins, scale, params, round_)
        # a task's rows are sums already, so they go straight to where the running sums are made
        sums = (state.mapInArrow(lambda it, a=args: _histograms(it, *a), "node int, feature int, bin int, n long, g long, h long")
                     .repartition("node", "feature").groupBy("node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in "ngh")))
        found = sorted(best_cuts(sums, scale, params).collect(), key=lambda r: r["node"])  # one row for each open node
        if not totals:
            tree = Tree()
            for r in found or [None]:
                add((r["n"], r["g"], r["h"]) if r else (0, 0, 0))
        open_nodes = []
        for r in found if params.max_depth else ():
            if r["gain"] is None:
                continue
            at, f, b = r["node"], r["feature"], r["bin"]
            tree.feature[at], tree.gain[at], tree.missing_left[at] = f, r["gain"], r["miss_left"]
            edge = cuts[f]
            tree.threshold[at] = float(edge[b - 1]) if b <= len(edge) else math.inf  # the last bin: only missing values go right
            cut[at] = b
            left = (r["n_left"], r["g_left"], r["h_left"])
            tree.left[at], tree.right[at] = add(left), add(tuple(a - b for a, b in zip(totals[at], left)))
            cut += [0, 0]
            open_nodes += [tree.left[at], tree.right[at]]
        if not open_nodes:
            break
    return tree, cut


# ------------------------------------------------------------------ exact explanations
@dataclass
class Leaf:
    """A leaf's game: its value, its path's features, their shares and the values that follow the path."""

    value: float
    features: np.ndarray
    zero: np.ndarray
    low: np.ndarray  # a row follows at feature j when low < x <= high
    high: np.ndarray
    missing: np.ndarray  # whether a missing value follows

    def ones(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.features]
        return np.where(np.isnan(v), self.missing, (v > self.low) & (v <= self.high))


def leaf_games(tree: Tree) -> list[Leaf]:
    """The games of a tree's leaves; cuts of one feature on a path become one interval and one share."""
    out, stack = [], [(0, {})]
    while stack:
        at, path = stack.pop()
        f = tree.feature[at]
        if f < 0:
            items = sorted(path.items())
            col = lambda i: np.array([v[i] for _, v in items])
            out.append(Leaf(tree.value[at], np.array([k for k, _ in items], np.int64), col(0).astype(float), col(1).astype(float),
                            col(2).astype(float), col(3).astype(bool)))
            continue
        for kid, is_left in ((tree.left[at], True), (tree.right[at], False)):
            zero, low, high, missing = path.get(f, (1.0, -math.inf, math.inf, True))
            zero *= tree.cover[kid] / tree.cover[at]
            low, high = (low, min(high, tree.threshold[at])) if is_left else (max(low, tree.threshold[at]), high)
            stack.append((kid, {**path, f: (zero, low, high, missing and tree.missing_left[at] == is_left)}))
    return out


def _products(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Coefficients of prod(zero_j + one_j t): (rows, d + 1)."""
    c = np.zeros((len(one), one.shape[1] + 1))
    c[:, 0] = 1
    for j in range(one.shape[1]):
        c[:, 1:] = c[:, 1:] * zero[j] + c[:, :-1] * one[:, j, None]
        c[:, 0] *= zero[j]
    return c


def _weights(n: int) -> np.ndarray:
    """k! (n - k)! / (n + 1)! for subsets of k out of n others."""
    return np.array([1 / ((n + 1) * math.comb(n, k)) for k in range(n + 1)])


def _patterns(leaf: Leaf, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ones, and each row's place among them: a leaf's values depend on these only."""
    ones = leaf.ones(x)
    code = ones @ (1 << np.arange(ones.shape[1])) if ones.shape[1] <= 60 else None
    if code is None:
        return np.unique(ones, axis=0, return_inverse=True)
    distinct, first, at = np.unique(code, return_index=True, return_inverse=True)
    return ones[first], at


def shapley(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Contributions of all features, (rows, features)."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        ones, at = _patterns(leaf, x)
        one = ones.astype(np.float64)
        phi, w = np.empty(one.shape), _weights(d - 1)
        for j in range(d):
            others = np.arange(d) != j
            phi[:, j] = leaf.value * (one[:, j] - leaf.zero[j]) * (_products(one[:, others], leaf.zero[others]) @ w)
        out[:, leaf.features] += phi[at]
    return out


def interaction_values(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Interactions of all pairs, (rows, features, features): symmetric, and rows add up to the contributions."""
    n, p = x.shape
    out = np.zeros((n, p, p))
    for leaf in leaves:
        d = len(leaf.features)
        if d < 2:
            continue
        ones, at = _patterns(leaf, x)
        one, w = ones.astype(np.float64), _weights(d - 2)
        for a in range(d):
            for b in range(a + 1, d):
                others = (np.arange(d) != a) & (np.arange(d) != b)
                both = (one[:, a] - leaf.zero[a]) * (one[:, b] - leaf.zero[b])
                v = (leaf.value / 2 * both * (_products(one[:, others], leaf.zero[others]) @ w))[at]
                i, j = leaf.features[a], leaf.features[b]
                out[:, i, j] += v
                out[:, j, i] += v
    phi = shapley(leaves, x)
    diagonal = np.arange(p)
    out[:, diagonal, diagonal] = phi - out.sum(axis=2)
    return out
