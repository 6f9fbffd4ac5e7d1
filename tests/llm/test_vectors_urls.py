"""Nearest neighbours against brute force; url rules and language models against plain versions."""

import math
from collections import Counter

import numpy as np
import pytest

from lodestar.llm import ann, url_filter


def vectors(spark, rows):
    return ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>, id long, v string"), "vec_id", "embedding")


def plain_nearest(rows, q, k):
    x = dict(rows)
    a = np.array(x[q], np.float32).astype(float)
    score = lambda b: (a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum()))
    found = sorted((-score(np.array(v, np.float32).astype(float)), i) for i, v in rows if i != q)
    return [(i, -s) for s, i in found[:k]]


def test_neighbours_and_recall(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 16))
    base[500:1500] = base[0]  # one very common vector
    rows = [(i, base[i].tolist()) for i in range(len(base))]
    odd = [(9000, None, 1, "x"), (9001, [0.0] * 16, 1, "x"), (9002, [float("nan")] * 16, 1, "x"), (9003, [1.0, None] * 8, 1, "x"),
           (9004, [1.0], 1, "x"), (None, base[1].tolist(), 1, "x"), (9005, [float("inf")] * 16, 1, "x"), (7, base[7].tolist(), 2, "y")]
    monkeypatch.setattr(ann, "BLOCK", 300)
    v = vectors(spark, [(i, x, 0, "v") for i, x in rows] + odd)
    got = {}
    for r in ann.search(v, v.where("id % 100 = 0"), k=5).collect():
        got.setdefault(r.query, []).append((r["rank"], r.id, r.score))
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        true = plain_nearest(rows, q, 5)
        hit += len({f[1] for f in found} & {t[0] for t in true})
        exact = dict(plain_nearest(rows, q, len(rows)))
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in found)
    assert hit >= 0.9 * 5 * len(got)
    assert [f[1] for f in got[600]] == [0, 500, 501, 502, 503]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    v = vectors(spark, [(i, [1.0, float(i)], 0, "") for i in range(n)])
    got = ann.search(v, v, k=5).collect()
    assert len(got) == n * (n - 1)


def test_traversal_is_in_order_of_summed_distance():
    rng = np.random.default_rng(3)
    books = rng.normal(size=(5, 4)), rng.normal(size=(7, 4))
    index = ann.MultiIndex(books, {c: 1 for c in range(35)})
    q = rng.normal(size=8)
    cells = [c for c, _ in index.traverse(q, 36)]
    total = [ann._distances(q[None, :4], books[0])[0][c // 7] + ann._distances(q[None, 4:], books[1])[0][c % 7] for c in cells]
    assert sorted(cells) == list(range(35)) and total == sorted(total)


# ------------------------------------------------------------------ urls
URLS = ["http://a.net/x", "https://A.Net", "http://b.example.net/en/1", "http://example.com/de/9?q", "http://x.org/fr/#t",
        "http://notexample.com/de/1", "http://x.org/en/1", "nothing", None, "", "http://example.com?x/de/", "ftp://net/",
        "http://example.com.net/de/2", "HTTP://é.org/fr/ü"] + [f"https://h{i}.example.net/{'en' if i % 2 else 'fr'}/{i}" for i in range(60)]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, rule in url_filter.RULES:
        domain, _, prefix = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


def plain_model(texts, order):
    tables = [{} for _ in range(order + 1)]
    for s in texts:
        s = url_filter.EDGE * order + s
        for i in range(order, len(s)):
            for k in range(order + 1):
                tables[k].setdefault(s[i - k:i], Counter())[s[i]] += 1

    def p(context, c):
        value = 1 / url_filter.ALPHABET
        for k in range(order + 1):
            seen = tables[k].get(context[order - k:])
            if seen:
                value = (seen[c] + len(seen) * value) / (sum(seen.values()) + len(seen))
        return value
    return p


def test_urls(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h"), (1, URLS[1], "h")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)).collect()
    assert len(got) == len(rows)
    said = {}
    for r in got:
        host, path, best = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[0] if best else r.verdict in ("allow", "block")
        said.setdefault(r.url, set()).add(r.verdict)
    assert all(len(v) == 1 for v in said.values())


def test_language_model_ratio(spark):
    order = 3
    train = [("http://good.site/abc", "allow"), ("http://good.site/abd", "allow"), ("http://bad.site/xyz", "block")]
    rest = ["http://good.site/abz", "http://bad.site/xy", "q", ""]
    df = spark.createDataFrame(train, "s string, verdict string")
    asked = spark.createDataFrame([(s,) for s in rest], "s string")
    wanted = url_filter.grams(asked, order).select("gram").distinct()
    got = {r.s: r.score for r in url_filter.url_scores(asked, url_filter.gram_scores(df, wanted, order), order).collect()}
    models = [plain_model([s for s, v in train if v == kind], order) for kind in ("allow", "block")]
    for s in rest:
        padded = url_filter.EDGE * order + s
        logs = [sum(math.log(m(padded[i - order:i], padded[i])) for i in range(order, len(padded))) for m in models]
        assert math.isclose(got[s], (logs[0] - logs[1]) / len(s) if s else 0.0, abs_tol=1e-9)


def test_calibration(spark):
    rows = [("allow", 0.5), ("allow", 0.4), ("block", -0.3), ("block", 0.1)]
    threshold = url_filter.calibrate(spark.createDataFrame(rows, "verdict string, score double"))
    assert 0.1 < threshold <= 0.4
    assert url_filter.calibrate(spark.createDataFrame(rows[:2], "verdict string, score double")) == 0.0


def test_no_pages(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
