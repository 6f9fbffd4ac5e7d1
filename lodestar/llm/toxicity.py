"""Toxicity: a classifier chain of linear models over word and word-beginning features.

Categories are judged in a fixed order; each is a logistic model over the same
selected features and the probabilities of the categories before it. While
training, those probabilities are out of fold: every labelled document is
scored by a model that did not see it, so a later model learns from the same
kind of input that it meets on new documents. The threshold of the last
category comes from its own out-of-fold probabilities (largest F1).

Models are fitted on a bounded sample of the labelled documents
(``max_train``, the smallest hashes of ``doc_id``); fits of folds run side by
side as Spark groups. Every document is then scored over its whole text.

Features are the presence of words (lower case) and of the first
``BEGINNING`` bytes of longer words, for words that occur in ``MIN_DOCS``
training documents or more and whose chi-square with some category is above
``MIN_CHI2``; the strongest ``MAX_FEATURES`` are kept.

Defined results: a null or empty text has no features; labels that are null are
left out, conflicting ones of a document count as positive; without labels of
both kinds a category's probability is the share of positives and nothing is
flagged; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.hashing import portable_bucket
from lodestar.llm import pretokens
from lodestar.llm.common import stored, without

#: Labelled documents that the models are fitted on, at most.
MAX_TRAIN = 20_000
FOLDS, SEED = 5, 11
BEGINNING = 5
MIN_DOCS, MIN_CHI2, MAX_FEATURES = 5, 30.0, 2_000
#: Strength of the penalty on squared weights.
PENALTY = 1.0
BATCH = 1 << 20
FLAG_NOTHING = 2.0


# ------------------------------------------------------------------ features
#: Base of the rolling hash; odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts, the words' starts and ends in them, and each word's text.

    A word is a run of ASCII letters and digits and of any non-ASCII bytes.
    """
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    inside = _WORD_BYTE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    return raw, starts, ends, np.searchsorted(stops, starts, "right")


_WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    inverse = pow(BASE, -1, 2**64)
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(raw)), dtype=np.uint64)])
    return scramble((sums[ends] - sums[starts]) * _powers(inverse, len(raw))[starts])


def text_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and every beginning, with repeats."""
    raw, starts, ends, doc = word_spans(texts)
    long = ends - starts > BEGINNING
    words = span_hashes(raw, starts, ends)
    begun = span_hashes(raw, starts[long], starts[long] + BEGINNING) ^ np.uint64(0x5BD1E995)
    return np.concatenate([doc, doc[long]]), np.concatenate([words, begun])


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pretokens.runs(batch["text"], BATCH):
            mine = batch.slice(part.start, part.stop - part.start)
            doc, feature = text_features(pretokens.texts_of(mine["text"]))
            order = np.lexsort((feature, doc))
            doc, feature = doc[order], feature[order]
            first = np.r_[True, (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])][:len(doc)]
            doc, feature = doc[first], feature[first]
            cuts = np.searchsorted(doc, np.arange(mine.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.view(np.int64)))
            columns = {c: mine[c] for c in mine.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict({**columns, "features": lists})


# ------------------------------------------------------------------ linear models
def fit_logistic(rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray, n_cols: int) -> np.ndarray:
    """Weights of a penalised logistic model: sparse 0/1 features, dense ones, then the constant.

    Newton steps; each is solved by conjugate gradients on products with the sparse features.
    """
    n, d = len(y), dense.shape[1]
    w = np.zeros(n_cols + d + 1)
    ridge = np.full(len(w), PENALTY)
    ridge[-1] = 1e-6

    def forward(v: np.ndarray) -> np.ndarray:
        return np.bincount(rows, v[cols], n) + dense @ v[n_cols:-1] + v[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(cols, r[rows], n_cols), dense.T @ r, [r.sum()]])

    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        grad = back(p - y) + ridge * w
        if np.abs(grad).max() < 1e-6 * n:
            break
        curve = np.maximum(p * (1 - p), 1e-9)
        x, r = np.zeros(len(w)), -grad
        q, rr = r.copy(), r @ r
        for _ in range(60):
            hq = back(curve * forward(q)) + ridge * q
            step = rr / (q @ hq)
            x += step * q
            r -= step * hq
            new = r @ r
            if new < 1e-10 * (grad @ grad):
                break
            q, rr = r + new / rr * q, new
        w = w + x * min(1.0, 10 / max(np.abs(x).max(), 1e-12))
    return w


def probabilities(w: np.ndarray, doc: np.ndarray, cols: np.ndarray, dense: np.ndarray) -> np.ndarray:
    n_cols = len(w) - dense.shape[1] - 1
    z = np.bincount(doc, w[cols], len(dense)) + dense @ w[n_cols:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sparse(lists: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    cols = np.concatenate(lists).astype(np.int64) if n.sum() else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(lists)), n), cols


def _matrix(lists: Sequence[Sequence[float]]) -> np.ndarray:
    return np.array([list(x) for x in lists], np.float64).reshape(len(lists), -1)


def _fit_group(pdf: pd.DataFrame, n_cols: int) -> pd.DataFrame:
    pdf = pdf.sort_values("doc_id")  # the order of sums, and so the last digits, don't depend on the shuffle
    rows, cols = _sparse(list(pdf.cols))
    y, dense = pdf.y.to_numpy(np.float64), _matrix(list(pdf.probs))
    if 0 < y.sum() < len(y):
        w = fit_logistic(rows, cols, dense, y, n_cols)
    else:  # one kind only: the constant says how often
        w = np.zeros(n_cols + dense.shape[1] + 1)
        w[-1] = 30.0 if len(y) and y.all() else -30.0
    return pd.DataFrame({"part": [pdf.part.iloc[0]], "w": [w.tolist()]})


# ------------------------------------------------------------------ operator
def training_rows(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_train: int) -> DataFrame:
    """(doc_id, fold, ys, features) of the sample, written once."""
    known = (labels.where(F.col("doc_id").isNotNull())
                   .select("doc_id", *(c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())))
                   .dropna().groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories)))))
    sample = (known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_train)
                   .select("doc_id", F.array(*(f"y{i}" for i in range(len(categories)))).alias("ys")))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by max_train
    one = texts.groupBy("doc_id").agg(F.first("ys").alias("ys"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    listed = one.mapInArrow(_feature_lists, "doc_id long, ys array<int>, features array<long>")
    return stored(listed.withColumn("fold", portable_bucket("doc_id", SEED, FOLDS).cast("int")), "toxicity-train")


def select_features(train: DataFrame, n_categories: int) -> np.ndarray:
    """The hashes of the kept features, sorted; ``MAX_FEATURES`` at most."""
    totals = train.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("ys")[i]).alias(f"p{i}") for i in range(n_categories))).first()
    n = totals["n"]
    counts = (train.select(F.explode("features").alias("f"), "ys").groupBy("f")
                   .agg(F.count(F.lit(1)).alias("df"), *(F.sum(F.col("ys")[i]).alias(f"t{i}") for i in range(n_categories)))
                   .where(F.col("df") >= MIN_DOCS))
    best = F.lit(0.0)
    for i in range(n_categories):
        pos = totals[f"p{i}"] or 0
        if not 0 < pos < n:
            continue
        both, df = F.col(f"t{i}").cast("double"), F.col("df").cast("double")
        off = both * n - df * pos
        chi2 = off * off * float(n) / (df * (n - df) * float(pos) * float(n - pos))
        best = F.greatest(best, chi2)
    kept = (counts.where(F.col("df") < n).withColumn("chi2", best).where(F.col("chi2") > MIN_CHI2)
                  .orderBy(F.desc("chi2"), "f").limit(MAX_FEATURES))
    return np.sort(np.array([r["f"] for r in kept.select("f").collect()], np.int64).view(np.uint64))


def _index(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Replaces feature hashes by their places among the kept ones."""
    for batch in batches:
        lists = batch["features"]
        values = np.asarray(lists.flatten()).view(np.uint64)
        rows = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        at = np.searchsorted(chosen, values)
        hit = (at < len(chosen)) & (chosen[np.minimum(at, max(len(chosen) - 1, 0))] == values) if len(chosen) else np.zeros(len(values), bool)
        cuts = np.searchsorted(rows[hit], np.arange(len(lists) + 1)).astype(np.int32)
        cols = pa.ListArray.from_arrays(pa.array(cuts), pa.array(at[hit].astype(np.int32)))
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "fold": batch["fold"], "ys": batch["ys"], "cols": cols})


def _out_of_fold(batches: Iterator[pa.RecordBatch], models: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, cols = _sparse([np.asarray(x, np.int64) for x in batch["cols"].to_pylist()])
        dense, fold = _matrix(batch["probs"].to_pylist()), batch["fold"].to_numpy()
        p = np.zeros(batch.num_rows)
        for f in np.unique(fold):
            p = np.where(fold == f, probabilities(models[int(f)], rows, cols, dense), p)
        out = {c: batch[c] for c in ("doc_id", "fold", "ys", "cols")}
        probs = [[*a, b] for a, b in zip(batch["probs"].to_pylist(), p.tolist())]
        yield pa.RecordBatch.from_pydict({**out, "probs": pa.array(probs, pa.list_(pa.float64()))})


class Chain:
    """A fitted chain: the kept features, a model for each category, and the last one's threshold."""

    def __init__(self, categories: Sequence[str], chosen: np.ndarray, models: Sequence[np.ndarray], threshold: float):
        self.categories, self.chosen, self.models, self.threshold = list(categories), chosen, list(models), threshold

    def score(self, texts: Sequence[str]) -> np.ndarray:
        """Probabilities, one row per text and one column per category."""
        doc, feature = text_features(texts)
        probs = np.zeros((len(texts), 0))
        if len(self.chosen):
            at = np.minimum(np.searchsorted(self.chosen, feature), len(self.chosen) - 1)
            hit = self.chosen[at] == feature
            pairs = np.unique(doc[hit] * np.int64(len(self.chosen)) + at[hit])
            rows, cols = pairs // len(self.chosen), pairs % len(self.chosen)
        else:
            rows = cols = np.zeros(0, np.int64)
        for w in self.models:
            probs = np.column_stack([probs, probabilities(w, rows, cols, probs)])
        return probs


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_train: int = MAX_TRAIN) -> Chain:
    """Fit the chain; ``categories`` maps names to 0/1 columns of ``labels``, in order."""
    train = training_rows(docs, labels, categories, max_train)
    chosen = select_features(train, len(categories))
    kind = "doc_id long, fold int, ys array<int>, cols array<int>"
    rows = train.select("doc_id", "fold", "ys", "features").mapInArrow(lambda it: _index(it, chosen), kind)
    rows = stored(rows.withColumn("probs", F.array().cast("array<double>")), "toxicity-rows")
    models, n_cols = [], len(chosen)
    for i in range(len(categories)):
        # part f leaves fold f out; part FOLDS leaves nothing out
        parts = F.filter(F.sequence(F.lit(0), F.lit(FOLDS)), lambda part: part != F.col("fold"))
        groups = rows.select("doc_id", F.explode(parts).alias("part"), "cols", "probs", F.col("ys")[i].alias("y"))
        fitted = {r["part"]: np.array(r["w"]) for r in groups.groupBy("part").applyInPandas(
            lambda pdf: _fit_group(pdf, n_cols), "part int, w array<double>").collect()}
        whole = fitted.get(FOLDS, np.concatenate([np.zeros(n_cols + i), [-30.0]]))
        models.append(whole)
        each = {f: fitted.get(f, whole) for f in range(FOLDS)}
        rows = stored(rows.mapInArrow(lambda it, m=each: _out_of_fold(it, m), kind + ", probs array<double>"),
                      f"toxicity-oof-{i}")
    last = len(categories) - 1
    # a thousandth is the grid of thresholds
    bins = (rows.select(F.floor(F.element_at("probs", -1) * 1000).alias("bin"), F.col("ys")[last].alias("y"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).collect())
    return Chain(list(categories), chosen, models, _best_f1(sorted((r["bin"], r["n"], r["pos"]) for r in bins)))


def _best_f1(bins: Sequence[tuple[int, int, int]]) -> float:
    """The threshold with the largest F1; in the middle between the neighbouring bins."""
    positives = sum(b[2] for b in bins)
    best, threshold, flagged, hit = 0.0, FLAG_NOTHING, 0, 0
    for k in range(len(bins) - 1, -1, -1):
        flagged, hit = flagged + bins[k][1], hit + bins[k][2]
        f1 = 2 * hit / (flagged + positives) if positives else 0.0
        if f1 > best:
            below = bins[k - 1][0] + 1 if k else 0
            best, threshold = f1, (bins[k][0] + below) / 2000
    return threshold


def score_documents(docs: DataFrame, chain: Chain, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``p_<category>`` (double, six digits) for each category and ``flagged`` (boolean)."""
    names = without(keep, [*(f"p_{c}" for c in chain.categories), "flagged"])
    kept = [f"k{i}" for i in range(len(names))]
    schema = T.StructType([*(T.StructField(k, docs.schema[c].dataType) for k, c in zip(kept, names)),
                           *(T.StructField(f"p{i}", T.DoubleType()) for i in range(len(chain.models))),
                           T.StructField("flagged", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pretokens.runs(batch["text"], BATCH):
                mine = batch.slice(part.start, part.stop - part.start)
                probs = chain.score(pretokens.texts_of(mine["text"]))
                columns = {k: mine[k] for k in kept}
                columns |= {f"p{i}": pa.array(np.round(probs[:, i], 6)) for i in range(probs.shape[1])}
                yield pa.RecordBatch.from_pydict({**columns, "flagged": pa.array(probs[:, -1] >= chain.threshold)})

    scored = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)), F.col("text").alias("text")).mapInArrow(run, schema)
    return scored.toDF(*names, *(f"p_{c}" for c in chain.categories), "flagged")
