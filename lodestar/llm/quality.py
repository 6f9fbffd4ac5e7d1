"""Quality classifier: a generalised additive model with pairwise interactions.

Each document has a few numbers taken from its whole text (``FEATURES``). A
model is a constant, one lookup table per feature and one per chosen pair of
features; a score is the logistic function of the looked-up sum. Tables are
learned by boosting in cycles: one feature after the other gets a shallow tree
over its bins, fitted to the gradient and curvature that its rows have at that
moment, and a small share of the tree is added to the feature's table. When the
single features have been learned, the pairs whose four-quadrant cuts gain most
get trees over two features in the same way. Rounds end when the log loss of
rows left out no longer falls.

Models are fitted on ``max_train`` labelled documents at most (the smallest
hashes of their ids), once per bag; a bag leaves out its own rows for stopping,
and the bags' tables are averaged. Bags are Spark groups of bounded size. Every
document is scored.

Defined results: a null or empty text has features of zero and a score; null
labels are left out, a document with several labels counts as the lowest, one
with several texts as the smallest; with labels of one kind only the score is 1
or 0, without any it is 1; repeated rows are scored alike; a null id passes
through. Very long texts are measured in whole. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm import pretokens
from lodestar.llm.common import stored, without
from lodestar.llm.toxicity import span_hashes

FEATURES = (
    "log_bytes", "letters", "capitals", "digits", "signs", "stops", "exclamations", "word_length", "long_words",
    "log_lines", "words_per_line", "distinct_words", "commonest_word", "repeated_next", "repeated_lines",
    "signed_words", "capital_words", "ended_lines", "lone_signs")
#: Labelled documents that the models are fitted on, at most.
MAX_TRAIN = 20_000
BAGS, LEFT_OUT = 6, 0.15
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, PATIENCE = 400, 120, 25
RATE, PENALTY, MIN_ROWS = 0.08, 1.0, 10
BATCH = 1 << 20


# ------------------------------------------------------------------ features
def _kinds() -> np.ndarray:
    """Of every byte: 0 space, 1 line end, 2 capital, 3 other letter, 4 digit, 5 full stop, 6 exclamation mark, 7 comma and the like, 8 other sign."""
    table = np.full(256, 8, np.uint8)
    table[128:] = 3
    for kind, chars in ((0, " \t\r\f\v"), (1, "\n"), (2, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, "abcdefghijklmnopqrstuvwxyz"),
                        (4, "0123456789"), (5, ".?"), (6, "!"), (7, ",;:'\"()-")):
        table[[ord(c) for c in chars]] = kind
    return table


_KIND = _kinds()


def features_of(texts: Sequence[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(texts)
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    length = np.fromiter(map(len, parts), np.int64, n)
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)  # a line end after each text
    stop = np.cumsum(length + 1)
    doc = np.repeat(np.arange(n), length + 1)
    kind = _KIND[raw]
    by_kind = np.bincount(doc * 9 + kind, minlength=9 * n).reshape(n, 9)[:, :9].astype(np.float64)
    by_kind[:, 1] -= 1
    size = np.maximum(length, 1)
    letters = by_kind[:, 2] + by_kind[:, 3]

    inside = kind > 1
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    word_doc = np.searchsorted(stop, starts, "right")
    hashes = span_hashes(raw, starts, ends)
    words = np.bincount(word_doc, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(word_doc, flags, n) / some

    def counted(table: np.ndarray) -> np.ndarray:
        """Of each word, how many of its bytes the table flags."""
        total = np.r_[0, np.cumsum(table[kind])]
        return total[ends] - total[starts]

    span = ends - starts
    is_letter = np.isin(np.arange(9), (2, 3))
    letter_count = counted(is_letter)
    last_kind = kind[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    order = np.lexsort((hashes, word_doc))
    h, d = hashes[order], word_doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])][:len(h)]
    runs = np.diff(np.r_[np.flatnonzero(new), len(h)])
    commonest = np.zeros(n)
    np.maximum.at(commonest, d[new], runs)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (word_doc[1:] == word_doc[:-1])][:len(hashes)]

    line_end = np.flatnonzero(raw == 10)
    line_start = np.r_[0, line_end[:-1] + 1]
    line_doc = doc[line_end]
    full = line_end > line_start
    line_doc, line_start, line_end = line_doc[full], line_start[full], line_end[full]
    lines = np.bincount(line_doc, minlength=n).astype(np.float64)
    any_line = np.maximum(lines, 1)
    line_hash = span_hashes(raw, line_start, line_end)
    order = np.lexsort((line_hash, line_doc))
    lh, ld = line_hash[order], line_doc[order]
    distinct = np.bincount(ld[np.r_[True, (lh[1:] != lh[:-1]) | (ld[1:] != ld[:-1])][:len(lh)]], minlength=n)
    ended = np.isin(kind[line_end - 1], (5, 6)) if len(line_end) else np.zeros(0, bool)

    columns = {
        "log_bytes": np.log1p(length), "letters": letters / size, "capitals": by_kind[:, 2] / np.maximum(letters, 1),
        "digits": by_kind[:, 4] / size, "signs": by_kind[:, 8] / size, "stops": by_kind[:, 5] / size,
        "exclamations": by_kind[:, 6] / size, "word_length": np.bincount(word_doc, span, n) / some,
        "long_words": share(span > 12), "log_lines": np.log1p(lines), "words_per_line": words / any_line,
        "distinct_words": np.bincount(d[new], minlength=n) / some, "commonest_word": commonest / some,
        "repeated_next": share(again), "repeated_lines": 1 - distinct / any_line,
        "signed_words": share((last_kind == 8) | (last_kind == 6)),
        "capital_words": share((letter_count > 1) & (counted(np.arange(9) == 2) == letter_count)),
        "ended_lines": np.bincount(line_doc, ended, n) / any_line, "lone_signs": share(letter_count == 0)}
    columns["repeated_lines"][lines == 0] = 0
    return np.column_stack([columns[f] for f in FEATURES])


def _with_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pretokens.runs(batch["text"], BATCH):
            mine = batch.slice(part.start, part.stop - part.start)
            values = features_of(pretokens.texts_of(mine["text"]))
            columns = {c: mine[c] for c in mine.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict({**columns, "x": pa.array(list(values), pa.list_(pa.float64()))})


# ------------------------------------------------------------------ model
class Tables(NamedTuple):
    """``edges`` cut each feature into bins (``coarse`` for pairs); ``single`` and ``double`` hold the tables."""

    constant: float
    edges: list
    coarse: list
    single: list
    pairs: list
    double: list

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.constant)
        for f, table in enumerate(self.single):
            z += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (f, g), table in zip(self.pairs, self.double):
            z += table[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Edges between bins of about equal numbers of values."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="inverted_cdf"))


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """A value for each bin: the bins are split at most ``depth`` times along their order, where it gains most."""
    out = np.empty(len(g))
    parts = [(0, len(g), depth)]
    while parts:
        a, b, left = parts.pop()
        total_g, total_h, total_n = g[a:b].sum(), h[a:b].sum(), n[a:b].sum()
        out[a:b] = -total_g / (total_h + PENALTY)
        if not left or b - a < 2:
            continue
        gl, hl, nl = g[a:b].cumsum()[:-1], h[a:b].cumsum()[:-1], n[a:b].cumsum()[:-1]
        gain = gl * gl / (hl + PENALTY) + (total_g - gl) ** 2 / (total_h - hl + PENALTY) - total_g ** 2 / (total_h + PENALTY)
        gain[(nl < MIN_ROWS) | (total_n - nl < MIN_ROWS)] = -1
        at = int(gain.argmax())
        if gain[at] > 1e-9:
            parts += [(a, a + at + 1, left - 1), (a + at + 1, b, left - 1)]
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four: its gain and a value for each cell."""
    def sums(m: np.ndarray) -> list[np.ndarray]:
        c = m.cumsum(0).cumsum(1)
        whole, rows, cols, low = c[-1, -1], c[:-1, -1:], c[-1:, :-1], c[:-1, :-1]
        return [low, rows - low, cols - low, whole - rows - cols + low]

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gs, hs = sums(g), sums(h)
    gain = sum(a * a / (b + PENALTY) for a, b in zip(gs, hs))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [-a[i, j] / (b[i, j] + PENALTY) for a, b in zip(gs, hs)]
    high, right = (np.arange(s) > k for s, k in zip(g.shape, (i, j)))
    cell = np.where(high[:, None], np.where(right[None], v[3], v[2]), np.where(right[None], v[1], v[0]))
    return float(gain[i, j]) - float(g.sum() ** 2 / (h.sum() + PENALTY)), cell


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z)) if len(y) else 0.0


def _cycles(steps: list, codes: list, y: np.ndarray, z: np.ndarray, stop: tuple, rounds: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Boosts tables in cycles. ``steps`` turn sums of gradient, curvature and rows into a tree; the best round's tables stay."""
    (stop_codes, stop_y, stop_z) = stop
    tables = [np.zeros(s.size) for s in steps]
    best, best_tables, since = _loss(stop_z, stop_y), [t.copy() for t in tables], 0
    for _ in range(rounds):
        for step, table, code, code_out in zip(steps, tables, codes, stop_codes):
            p = 1 / (1 + np.exp(-z))
            tree = RATE * step(np.bincount(code, p - y, step.size), np.bincount(code, p * (1 - p), step.size),
                               np.bincount(code, minlength=step.size))
            table += tree
            z += tree[code]
            stop_z += tree[code_out]
        now = _loss(stop_z, stop_y)
        if now < best - 1e-5:
            best, best_tables, since = now, [t.copy() for t in tables], 0
        elif (since := since + 1) >= PATIENCE:
            break
    z = z + sum((b - t)[c] for b, t, c in zip(best_tables, tables, codes))
    stop_z = stop_z + sum((b - t)[c] for b, t, c in zip(best_tables, tables, stop_codes))
    return best_tables, z, stop_z


class _Line:
    def __init__(self, size: int):
        self.size = size

    def __call__(self, g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        return shallow_tree(g, h, n)


class _Grid:
    def __init__(self, shape: tuple[int, int]):
        self.shape, self.size = shape, shape[0] * shape[1]

    def __call__(self, g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        return quadrants(g.reshape(self.shape), h.reshape(self.shape))[1].ravel()


def fit_tables(x: np.ndarray, y: np.ndarray, out: np.ndarray) -> Tables:
    """A model of rows with 0/1 ``y``; the rows flagged by ``out`` only say when to stop."""
    n_features = x.shape[1]
    edges = [cuts(x[~out, f], BINS) for f in range(n_features)]
    coarse = [cuts(x[~out, f], PAIR_BINS) for f in range(n_features)]
    code = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    mean = np.clip(y[~out].mean(), 1e-4, 1 - 1e-4)
    constant = float(np.log(mean / (1 - mean)))
    z, z_out = np.full(int((~out).sum()), constant), np.full(int(out.sum()), constant)
    single, z, z_out = _cycles([_Line(len(e) + 1) for e in edges], [c[~out] for c in code], y[~out], z,
                               ([c[out] for c in code], y[out], z_out), ROUNDS)
    wide = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    p = 1 / (1 + np.exp(-z))
    ranked = []
    for f in range(n_features):
        for k in range(f + 1, n_features):
            shape = (len(coarse[f]) + 1, len(coarse[k]) + 1)
            both = wide[f][~out] * shape[1] + wide[k][~out]
            size = shape[0] * shape[1]
            gain = quadrants(np.bincount(both, p - y[~out], size).reshape(shape),
                             np.bincount(both, p * (1 - p), size).reshape(shape))[0]
            ranked.append((-gain, f, k))
    pairs = [(f, k) for gain, f, k in sorted(ranked)[:PAIRS] if gain < 0]
    shapes = [(len(coarse[f]) + 1, len(coarse[k]) + 1) for f, k in pairs]
    both = [wide[f] * s[1] + wide[k] for (f, k), s in zip(pairs, shapes)]
    double, _, _ = _cycles([_Grid(s) for s in shapes], [c[~out] for c in both], y[~out], z,
                           ([c[out] for c in both], y[out], z_out), PAIR_ROUNDS)
    return Tables(constant, edges, coarse, single, pairs, [t.reshape(s) for t, s in zip(double, shapes)])


class QualityModel:
    """The bags' models; a score is the mean of their probabilities."""

    def __init__(self, bags: Sequence[Tables], constant: float):
        self.bags, self.constant = list(bags), constant

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.mean([b.scores(x) for b in self.bags], axis=0) if self.bags else np.full(len(x), self.constant)


# ------------------------------------------------------------------ operator
def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_train: int) -> DataFrame:
    """(doc_id, y, x) of the sample, written once; ``learn`` says which ids may be learned from."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(learn)
                   .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y")))
    sample = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_train).select("doc_id", "y")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by max_train
    one = texts.groupBy("doc_id").agg(F.first("y").alias("y"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return stored(one.mapInArrow(_with_features, "doc_id long, y int, x array<double>"), "quality-train")


def _fit_bag(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("doc_id")  # sums in the same order, whatever the shuffle
    bag = int(pdf.bag.iloc[0])
    x, y = np.array(pdf.x.tolist(), np.float64), pdf.y.to_numpy(np.float64)
    out = pdf.spot.to_numpy() < LEFT_OUT
    if not 0 < y[~out].sum() < (~out).sum():
        out = np.zeros(len(y), bool)
    t = fit_tables(x, y, out)
    lists = lambda arrays: [np.ravel(a).tolist() for a in arrays]
    return pd.DataFrame({"bag": [bag], "constant": [t.constant], "edges": [lists(t.edges)], "coarse": [lists(t.coarse)],
                         "single": [lists(t.single)], "pairs": [[list(p) for p in t.pairs]], "double": [lists(t.double)]})


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None,
                max_train: int = MAX_TRAIN) -> QualityModel:
    """Fit on the labelled documents (labels 0 and 1) whose label rows satisfy ``learn``."""
    train = training_rows(docs, labels, label, F.lit(True) if learn is None else learn, max_train)
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).first()
    if not seen["n"] or seen["good"] in (0, seen["n"]):
        return QualityModel([], 1.0 if not seen["n"] or seen["good"] else 0.0)
    bags = train.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(BAGS - 1))))
    bags = bags.withColumn("spot", F.pmod(F.xxhash64("doc_id", "bag"), F.lit(10_000)) / 10_000)
    kind = ("bag int, constant double, edges array<array<double>>, coarse array<array<double>>, single array<array<double>>, "
            "pairs array<array<int>>, double array<array<double>>")
    models = []
    for r in sorted(bags.groupBy("bag").applyInPandas(_fit_bag, kind).collect(), key=lambda r: r["bag"]):
        arrays = {k: [np.array(v) for v in r[k]] for k in ("edges", "coarse", "single", "double")}
        shape = [(len(arrays["coarse"][f]) + 1, len(arrays["coarse"][g]) + 1) for f, g in r["pairs"]]
        models.append(Tables(r["constant"], arrays["edges"], arrays["coarse"], arrays["single"], [tuple(p) for p in r["pairs"]],
                             [t.reshape(s) for t, s in zip(arrays["double"], shape)]))
    return QualityModel(models, 1.0)


def score_documents(docs: DataFrame, model: QualityModel, keep: Sequence[str] = ("doc_id",), score: str = "score") -> DataFrame:
    """Columns ``keep`` with the score (double, six digits)."""
    names = without(keep, [score])
    kept = [f"k{i}" for i in range(len(names))]
    schema = T.StructType([*(T.StructField(k, docs.schema[c].dataType) for k, c in zip(kept, names)), T.StructField("p", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.runs(batch["text"], BATCH):
                mine = batch.slice(part.start, part.stop - part.start)
                p = model.score(features_of(pretokens.texts_of(mine["text"])))
                yield pa.RecordBatch.from_pydict({**{k: mine[k] for k in kept}, "p": pa.array(np.round(p, 6))})

    rows = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)), F.col("text").alias("text"))
    return rows.mapInArrow(run, schema).toDF(*names, score)
