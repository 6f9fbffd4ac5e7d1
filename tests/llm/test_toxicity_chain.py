"""The whole classifier chain against a plain version: features, selection, folds, chained fits and threshold."""

import hashlib
import math
import re

import numpy as np

from lodestar.llm import queries, toxicity
from lodestar.plans.catalog import load

SF = "/root/testdata/sf0.01"


def plain_features(text):
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").lower().encode())
    return {b"w" + w for w in words} | {b"b" + w[:toxicity.BEGINNING] for w in words if len(w) > toxicity.BEGINNING}


def plain_fit(x, y):
    """Penalised logistic regression by Newton steps on dense rows (the last column is the constant)."""
    if not 0 < y.sum() < len(y):
        return np.r_[np.zeros(x.shape[1] - 1), 30.0 if y.all() else -30.0]
    ridge, w = np.r_[np.full(x.shape[1] - 1, toxicity.PENALTY), 1e-6], np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * np.maximum(p * (1 - p), 1e-9)[:, None]) + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 10 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def plain_chain(docs, labels):
    """{doc: (p_low_quality, p_toxic)} and the threshold."""
    ids = sorted(i for i in labels if i in docs)
    ys = np.array([labels[i] for i in ids], float)
    sets = [plain_features(docs[i]) for i in ids]
    n, df = len(ids), {}
    for s, y in zip(sets, ys):
        for f in s:
            df.setdefault(f, np.zeros(3))
            df[f] += [1, *y]
    pos, kept = ys.sum(0), []
    for f, (d, *both) in df.items():
        chi2 = max((b * n - d * p) ** 2 * n / (d * (n - d) * p * (n - p)) if d < n else 0 for b, p in zip(both, pos))
        if toxicity.MIN_DOCS <= d < n and chi2 > toxicity.MIN_CHI2:
            kept.append(f)
    assert 0 < len(kept) < toxicity.MAX_FEATURES
    row = lambda s: [float(f in s) for f in kept]
    base, every = np.array([row(s) for s in sets]), np.array([row(plain_features(docs[i])) for i in docs])
    fold = np.array([int(hashlib.md5(f"{i}-{toxicity.SEED}".encode()).hexdigest()[:8], 16) % toxicity.FOLDS for i in ids])
    probs, scored = np.zeros((n, 0)), np.zeros((len(docs), 0))
    for c in range(2):
        x, z = np.column_stack([base, probs, np.ones(n)]), np.column_stack([every, scored, np.ones(len(docs))])
        out = np.zeros(n)
        for f in range(toxicity.FOLDS):
            w = plain_fit(x[fold != f], ys[fold != f, c])
            out[fold == f] = 1 / (1 + np.exp(-np.clip(x[fold == f] @ w, -30, 30)))
        whole = plain_fit(x, ys[:, c])
        probs = np.column_stack([probs, out])
        scored = np.column_stack([scored, 1 / (1 + np.exp(-np.clip(z @ whole, -30, 30)))])
    bins, best, threshold = np.floor(probs[:, 1] * 1000), 0.0, 2.0
    cells = sorted(set(bins))
    for k in range(len(cells) - 1, -1, -1):
        flagged = bins >= cells[k]
        f1 = 2 * (ys[flagged, 1]).sum() / (flagged.sum() + ys[:, 1].sum())
        if f1 > best:
            best, threshold = f1, (cells[k] + (cells[k - 1] + 1 if k else 0)) / 2000
    return dict(zip(docs, scored)), threshold


def test_chain_equals_a_plain_version(spark):
    docs = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    labels = {}
    for r in load(spark, SF, "labels").collect():
        if r.doc_id is not None and r.quality is not None and r.toxic is not None:
            y = labels.setdefault(r.doc_id, [0, 0])
            labels[r.doc_id] = [max(y[0], int(r.quality == 0)), max(y[1], int(r.toxic == 1))]
    want, threshold = plain_chain(docs, labels)
    got = queries.op3_toxicity(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        low, toxic = want[r.doc_id]
        assert math.isclose(r.p_low_quality, low, abs_tol=2e-3) and math.isclose(r.p_toxic, toxic, abs_tol=2e-3)
        assert r.toxic == (toxic >= threshold) or abs(toxic - threshold) < 2e-3
