"""Line dedup, string dedup, n-gram join, decontamination and toxicity against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import decontaminate, line_dedup, ngram_join, suffix_dedup, toxicity
from lodestar.llm.groups import components

SCHEMA = "doc_id long, text string, d long, t string, n int, line string, shard long"
WORD = re.compile(r"(?:[a-z0-9]|[^\x00-\x7f])+")


def frame(spark, pairs, parts=3):
    """Documents with columns whose names the operators use inside as well."""
    return spark.createDataFrame([(i, t, 5, None, 1, "line", 0) for i, t in pairs], SCHEMA).repartition(parts)


def babble(rng, n, words=400):
    return " ".join(rng.choice(VOCABULARY[:words]) for _ in range(n))


VOCABULARY = ["".join(random.Random(i).choice("abcdefghiéß") for _ in range(3 + i % 6)) for i in range(400)]


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text): copies, near copies, shared passages and lines, and all the odd cases."""
    rng = random.Random(3)
    passage, line = babble(rng, 30), "The very same line, again and again"
    base = babble(rng, 120)
    out = [(0, None), (1, ""), (2, "..."), (3, line), (4, line.upper() + "  "), (5, "short\nshort"), (6, "short")]
    out += [(i, babble(rng, rng.randint(5, 60)) + "\n" + line + "\n" + babble(rng, 10)) for i in range(10, 40)]
    out += [(i, babble(rng, 20) + " " + passage + " " + babble(rng, 20)) for i in range(40, 60)]
    out += [(i, base) for i in range(60, 75)]
    for i in range(75, 100):
        words = base.split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        out.append((i, " ".join(words)))
    out += [(100, "a" * 700), (101, "b" + "a" * 90), (102, "\n\n \n"), (None, base), (None, "x " + passage)]
    out += [(61, base), (45, "another text of document 45 " + passage)]
    return out


def late(i):
    return float("inf") if i is None else i


# ------------------------------------------------------------------ lines
def plain_lines(rows):
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(late(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == late(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("shard_keys", [3, 50_000])
def test_line_dedup(spark, corpus, shard_keys):
    got = line_dedup.dedup_lines(frame(spark, corpus), shard_keys=shard_keys).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text or "") for r in got) == sorted(
        (str(i), *rest) for i, *rest in plain_lines(corpus))
    assert {r["line"] for r in got} == {"line"}


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 2**63, n, np.uint64))
        packed, sizes = line_dedup.build_hash(keys)
        assert sorted(line_dedup.lookup_hash(packed, sizes, keys)) == list(range(len(keys)))


# ------------------------------------------------------------------ strings
def plain_strings(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, late(i)), late(i))
    out = []
    for i, t in rows:
        b, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < late(i):
                gone[k:k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("step", [1 << 19, 64])
def test_string_dedup(spark, corpus, step, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STEP", step)  # pieces of long texts, in the parts below
    texts = [(t or "").encode() for _, t in corpus]
    seen = {}
    for numbers, offsets, parts in suffix_dedup.pieces(texts, 50):
        w = suffix_dedup.Windows(parts, 50)
        for s, p in zip(w.start.tolist(), w.part.tolist()):
            seen[numbers[p], int(s - w.begin[p] + offsets[p])] = seen.get((numbers[p], int(s - w.begin[p] + offsets[p])), 0) + 1
    assert seen == {(i, k): 1 for i, t in enumerate(texts) for k in range(len(t) - 49)}
    got = suffix_dedup.dedup_strings(frame(spark, corpus)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == sorted(
        (str(i), *rest) for i, *rest in plain_strings(corpus))


def test_string_dedup_of_an_empty_table(spark):
    assert suffix_dedup.dedup_strings(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def phrases():
    """Documents that hold one short phrase among neighbours of their own; a few of them repeat others' neighbours."""
    rng = random.Random(12)
    own = [babble(rng, 12) + " All rights reserved, see the licence. " + babble(rng, 12) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(own)] + [(60 + i, "x " + own[i][:100 + i] + babble(rng, 5)) for i in range(20)]
    return rows + [(None, "y " + own[3][20:]), (7, "z " + own[9][10:])]


@pytest.mark.parametrize("hot", [0, 1, 5, 10**6])
def test_strings_around_common_phrases(spark, corpus, phrases, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_BUCKET", 2000)
    for rows in (phrases, [(i, t) for i, t in corpus if t != "a" * 700]):
        wanted = rows_of_removed(suffix_dedup, spark, rows, monkeypatch, 10**6)
        assert rows_of_removed(suffix_dedup, spark, rows, monkeypatch, hot) == wanted and any(w[2] for w in wanted)


def rows_of_removed(module, spark, rows, monkeypatch, hot):
    """The operator's rows, with ``HOT`` as given in the workers as well."""
    shared = module._shared

    def with_hot(batches):
        from lodestar.llm import suffix_dedup as there
        there.HOT = hot
        yield from shared(batches)
    monkeypatch.setattr(module, "_shared", with_hot)
    out = module.dedup_strings(frame(spark, rows), keep=["doc_id"]).collect()
    monkeypatch.setattr(module, "_shared", shared)
    return sorted((late(r.doc_id), bytes(r.kept), r.n_removed, r.n_spans) for r in out)


def test_a_common_phrase_is_dealt_out(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(suffix_dedup, "HOT", 100)
    rng, length, buckets = random.Random(2), 50, 64
    texts = [babble(rng, 8) + " All rights reserved, see the licence. " + babble(rng, 8) for _ in range(2000)]
    table = pa.table({"text": texts, "d": pa.array(range(2000), pa.int64()), "t": pa.array(range(2000), pa.int64())})
    with np.errstate(over="ignore"):
        posted = pa.Table.from_batches(suffix_dedup._post(iter(table.to_batches(max_chunksize=100)), buckets, length))
        shared = pa.Table.from_batches(suffix_dedup._shared(iter(posted.sort_by("bucket").to_batches()))).to_pylist()
        hot = np.array([r["hot"] for r in shared if r["hot"] is not None], np.int64).view(np.uint64)
        at = {}
        for r in shared:
            if r["hot"] is None:
                at.setdefault(r["d"], []).append(r["at"])
        table = table.append_column("at", pa.array([at.get(i, []) for i in range(2000)], pa.list_(pa.int64())))
        sent = pa.Table.from_batches(suffix_dedup._contexts(iter(table.to_batches(max_chunksize=100)), buckets, length, hot))
    size = {}
    for b, data in zip(sent["bucket"].to_pylist(), sent["bytes"].to_pylist()):
        size[b] = size.get(b, 0) + len(data)
    assert len(hot) and max(size.values()) < 3 * sum(size.values()) / buckets


# ------------------------------------------------------------------ n-grams
def plain_join(rows, n=5, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets[i, t] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else None
    name = {}
    for (i, _), s in sets.items():
        if s is not None:
            name[s] = min(name.get(s, late(i)), late(i))
    classes = list(name)
    links, up = {s: 0 for s in classes}, {s: s for s in classes}

    def root(s):
        while up[s] != s:
            s = up[s]
        return s

    for a, x in enumerate(classes):
        for y in classes[:a]:
            if 10 * len(x & y) >= 8 * len(x | y):
                links[x] += 1
                links[y] += 1
                up[root(x)] = root(y)
    group = {}
    for s in classes:
        group[root(s)] = min(group.get(root(s), late(None)), name[s])
    return {(i, name[s], links[s], group[root(s)]) if s is not None else (i, late(i), 0, late(i)) for (i, _), s in sets.items()}


@pytest.mark.parametrize("block", [512, 7])
def test_ngram_join(spark, corpus, block):
    got = ngram_join.joined(frame(spark, corpus), block=block).collect()
    assert {(r.doc_id, late(r.class_id), r.n_links, late(r.group_id)) for r in got} == plain_join(corpus)


def test_one_document_of_each_group_stays(spark, corpus):
    got = ngram_join.drop_near_copies(frame(spark, corpus))
    plain = plain_join(corpus)
    stay = {late(g) for _, _, _, g in plain}
    assert {late(r.doc_id) for r in got.collect()} == stay
    assert got.columns == frame(spark, corpus).columns


def test_prefixes_are_shortened_until_the_measured_recall_is_met():
    rng = random.Random(7)
    near = [(0.8 + 0.1 * rng.random(), rng.choice([3, 4, 5, 6])) for _ in range(200)]
    equal = [(1.0, 6)] * 5000
    depth, recall = ngram_join.measured(near + equal + [(0.5, 0)] * 50, 0.8, 6, 0.999)
    assert depth == 3 and recall == 1.0  # the many equal pairs don't hide the near ones
    assert ngram_join.measured(equal, 0.8, 6, 0.999) == (6, 1.0)
    assert ngram_join.measured([(0.79, 6)], 0.8, 6, 0.999) is None
    assert ngram_join.measured([(0.9, 0)] * 40, 0.8, 6, 0.999) == (ngram_join.FLOOR, 0.0)


def test_the_joins_depth_comes_from_its_parameters_not_from_sampled_pairs(spark, corpus, monkeypatch):
    asked = []

    def spied(*parameters):
        asked.append(parameters)
        return plain(*parameters)

    plain = ngram_join.shortened
    monkeypatch.setattr(ngram_join, "shortened", spied)
    got = ngram_join.joined(frame(spark, corpus)).collect()
    assert asked == [(ngram_join.THRESHOLD, ngram_join.TREES, ngram_join.DEPTH, ngram_join.TARGET)]
    assert {(r.doc_id, late(r.class_id), r.n_links, late(r.group_id)) for r in got} == plain_join(corpus)


def test_recall_of_near_copies(spark):
    """Pairs of similarity around the threshold in a larger corpus: at least nine of ten are found (all of them, mostly)."""
    rng = random.Random(11)
    rows = []
    for i in range(150):
        words = [rng.choice(VOCABULARY) + str(rng.randrange(50)) for _ in range(120)]
        rows.append((2 * i, " ".join(words)))
        for k in rng.sample(range(120), rng.randint(1, 3)):
            words[k] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    want, got = {r[0]: r[2] for r in plain_join(rows)}, {r.doc_id: r.n_links for r in ngram_join.joined(frame(spark, rows)).collect()}
    assert sum(want.values()) > 100 and sum(got.values()) >= 0.9 * sum(want.values())
    assert all(got[i] <= want[i] for i in want)


def test_only_agreeing_pairs_are_compared():
    sets = [np.arange(k, k + 50, dtype=np.uint64) for k in range(0, 200, 10)]
    wanted = np.zeros((20, 20), bool)
    wanted[0, 1] = wanted[3, 4] = True
    assert ngram_join.common(sets, sets, wanted).sum() == 80
    every = ngram_join.common(sets, sets, np.ones((20, 20), bool))
    assert (every == [[max(0, 50 - 10 * abs(i - j)) for j in range(20)] for i in range(20)]).all()


def test_ngram_join_of_an_empty_table(spark):
    assert ngram_join.joined(frame(spark, [])).count() == 0
    assert ngram_join.drop_near_copies(frame(spark, [(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("words", [0, 1, 2, 3, 4, 5, 6])
def test_shingles_of_few_words(words):
    with np.errstate(over="ignore"):
        (alone,) = ngram_join.shingles([" ".join(VOCABULARY[:words])])
        among = ngram_join.shingles([" ".join(VOCABULARY[:words]), " ".join(VOCABULARY[20:40])])[0]
    assert alone.tolist() == among.tolist() and len(alone) == (max(1, words - 4) if words else 0)


def test_ngram_join_of_one_row_partitions(spark):
    rows = [(i, " ".join(VOCABULARY[:1 + i % 4])) for i in range(8)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    got = ngram_join.joined(docs).collect()
    assert {(r.doc_id, r.class_id, r.n_links, r.group_id) for r in got} == plain_join(rows)


def test_prefixes_are_shortened_to_the_target():
    assert ngram_join.shortened(0.8, 20, 6, 0.999) == 5
    assert ngram_join.shortened(0.99, 20, 6, 0.999) == 6


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)]
    up = {k: k for e in edges for k in e}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(k, root(k)) for k in up}


# ------------------------------------------------------------------ decontamination
def plain_contamination(rows, items, length=13):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = [(str(i) if i is not None else None, w[k:k + length]) for i, t in items if (w := low(t))
               for k in range(max(1, len(w) - length + 1))]
    out = []
    for i, t in rows:
        w, hit, named = low(t), set(), set()
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k:k + len(x)] == x:
                    hit |= set(range(k, k + len(x)))
                    named.add(item)
        named.discard(None)
        out.append((str(i), len(w), len(hit), len(named), sorted(named), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_contamination(spark):
    rng = random.Random(4)
    words = [rng.choice(VOCABULARY) for _ in range(60)]
    items = [(1, " ".join(words[:30])), (2, "Once " + " ".join(words[10:24])), (30, "ÉCLAIR alpha"), (4, None), (5, "!!"),
             (None, "nobody knows"), (6, "aa aa aa aa aa aa aa aa aa aa aa aa aa aa"), (1, " ".join(words[:30]))]
    rows = [(0, None), (1, ""), (2, " ".join(words).title()), (3, ", ".join(words[5:20])), (4, "an ÉCLAIR! Alpha"),
            (5, "éclair alpha"), (6, "aa " * 40), (7, babble(rng, 900) + " " + " ".join(words[3:18])), (8, "nobody KNOWS"),
            (8, "nobody knows"), (8, "nobody knows"), (None, " ".join(words[:13])), (9, " ".join(words[:12]))]
    got = decontaminate.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got.collect()) == \
        plain_contamination(rows, items)


def test_contamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(frame(spark, [(1, "a b")]), none).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got] == [(1, 2, 0, False)]
    assert decontaminate.contamination(frame(spark, []), none).count() == 0


def test_near_places(spark):
    items = spark.createDataFrame([(1, "uno due tre quattro")], "item_id long, text string")
    docs = frame(spark, [(1, "uno due e tre quattro"), (2, "uno due tre quattro"), (3, "quattro " + "x " * 30 + "due uno tre")])
    wanted = decontaminate.phrases(items, 13)
    candidates = decontaminate.candidate_terms(wanted)
    postings = decontaminate.post(docs, candidates.select("term").distinct())
    chosen = decontaminate.anchors(candidates, postings)
    near = {r.d for r in decontaminate.near_places(postings, chosen, 1).collect()}
    assert 2 in near and 3 not in near


# ------------------------------------------------------------------ toxicity
def test_chain_finds_marked_documents(spark):
    rng = random.Random(6)
    bad = ["vileword", "badprefixone", "badprefixtwo"]
    rows, labels = [], []
    for i in range(600):
        text = babble(rng, 40)
        toxic = i % 5 == 0
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
            text = " ".join(words)
        rows.append((i, text))
        if i < 400:
            labels.append((i, int(i % 3 > 0), int(toxic)))
    rows += [(600, None), (601, ""), (602, "VILEWORD " + "fine " * 5000 + "vileword badprefixthree"), (None, "vileword badprefixone " * 3)]
    docs = frame(spark, rows)
    given_labels = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(docs, given_labels, {"low": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    got = {r.doc_id: r for r in toxicity.score_documents(docs, chain, keep=["doc_id", "text", "n"]).collect()}
    assert len(got) == len(rows)
    wrong = [i for i in range(400, 600) if got[i].flagged != (i % 5 == 0)]
    assert len(wrong) <= 2
    assert not got[600].flagged and not got[601].flagged and got[None].flagged and got[602].flagged
    assert len(chain.models[1]) == len(chain.models[0]) + 1  # the first category's probability feeds the second model


def test_chain_without_labels(spark):
    docs = frame(spark, [(1, "a b c"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(docs, labels, {"low": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    assert [r.flagged for r in toxicity.score_documents(docs, chain).collect()] == [False, False]
    assert toxicity.score_documents(frame(spark, []), chain).count() == 0


def test_logistic_fit_meets_its_equations():
    rng = np.random.default_rng(0)
    n, k = 300, 6
    x = (rng.random((n, k)) < 0.3).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ rng.normal(size=k) - 0.5)))).astype(float)
    rows, cols = np.nonzero(x)
    w = toxicity.fit_logistic(rows, cols, np.zeros((n, 0)), y, k)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(x.T @ (p - y) + toxicity.PENALTY * w[:-1]).max() < 1e-3 and abs((p - y).sum()) < 1e-3
