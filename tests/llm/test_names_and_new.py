"""Extra columns under any name, and the operators of quality, hard negatives and conversation tries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import (bpe, conversation_trie, decontaminate, hard_negatives, line_dedup, ngram_join, quality, queries, suffix_dedup,
                          token_counts, toxicity, url_filter)
from lodestar.plans.catalog import load

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
EXTRA = ["_d", "_t", "_s", "_gone", "d", "t", "s", "gone", "host", "path", "score", "n_lines", "n_tokens", "flagged", "kept", "ids",
         "line", "bits", "a.b", "value", "said", "k0", "own_2", "N_Chars2"]
LINE = "the same line in both of them"


@pytest.fixture(scope="module")
def wide(spark):
    """Documents with many other columns, each holding its row's mark; null and empty texts among them."""
    rows = [(1, f"first one\n{LINE}\nlast one of the first"), (2, f"{LINE}\nother words here"), (3, None), (None, ""), (5, "plain")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), key) for c in EXTRA})


def untouched(out, columns, n=5):
    rows = out.collect()
    assert len(rows) == n and len({c.lower() for c in out.columns}) == len(out.columns)
    for r in rows:
        for c in columns:
            assert r[c] == f"{c}:{r['doc_id'] or 0}"
    return rows


KEEPING = {
    "line_dedup": lambda df: line_dedup.dedup_lines(df),
    "ngram_join": lambda df: ngram_join.drop_near_copies(df),
    "token_counts": lambda df: token_counts.count_tokens(df, RANKS, keep=df.columns),
    "bpe": lambda df: bpe.encode_documents(df, RANKS, keep=df.columns),
    "suffix_dedup": lambda df: suffix_dedup.dedup_strings(df, keep=df.columns),
    "toxicity": lambda df: toxicity.score_documents(df, toxicity.Chain(["toxic"], np.zeros(0, np.uint64), [np.array([-30.0])], 0.5), keep=df.columns),
    "quality": lambda df: quality.score_documents(df, quality.QualityModel([], 1.0), keep=df.columns),
}


@pytest.mark.parametrize("name", sorted(KEEPING))
def test_other_columns_keep_their_values(wide, name):
    out = KEEPING[name](wide)
    made = {"line_dedup": {"n_lines"}, "token_counts": {"n_tokens"}, "bpe": {"ids"}, "suffix_dedup": {"kept"},
            "toxicity": {"flagged"}, "quality": {"score"}}.get(name, set())
    untouched(out, [c for c in EXTRA if c not in made])


def test_url_results_replace_columns_of_their_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None), (3, "http://b.org/fr/y")], "doc_id long, url string")
    pages = pages.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in EXTRA})
    rows = untouched(url_filter.judge(pages), [c for c in EXTRA if c not in ("host", "path", "score")], 3)
    assert {r["doc_id"]: r["host"] for r in rows} == {1: "a.net", 2: "", 3: "b.org"}


def test_decontamination_reads_its_columns_only(spark, wide):
    items = spark.createDataFrame([(1, "plain")], "item_id long, text string").withColumn("d", F.lit(1)).withColumn("phrase", F.lit(2))
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.contamination(wide, items).collect()}
    assert got == {1: False, 2: False, 3: False, None: False, 5: True}


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns_of_documents(spark, wide, stage):
    docs = wide.withColumn("n_chars", F.char_length("text").cast("long"))
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}:{r['doc_id'] or 0}" for c in EXTRA)


# ------------------------------------------------------------------ line hashes that fold into one key
def test_lines_whose_hashes_fold_into_one_key_are_told_apart():
    import pandas as pd
    h2 = np.array([7, 8, 9, 10], np.int64)
    h1 = (np.uint64(5) ^ line_dedup._mix(h2.view(np.uint64), 0)).view(np.int64)
    h1[3] = 77
    assert len(set(line_dedup._folded(h1, h2).tolist())) == 2
    with pytest.raises(ValueError):
        line_dedup.build_hash(line_dedup._folded(h1, h2))
    shard = line_dedup._build_shard(pd.DataFrame({"h1": h1, "h2": h2, "n_lines": [2, 3, 4, 5], "first": [1, 2, 3, 4], "last": [9, 9, 3, 9], "shard": 0}))
    count, first = line_dedup._Shard(shard.iloc[0].to_dict()).probe(h1[[2, 0, 1, 3]], h2[[2, 0, 1, 3]])
    assert count.tolist() == [4, 2, 3, 5] and first.tolist() == [-1, 1, 2, 4]


# ------------------------------------------------------------------ quality
def test_quality_of_held_out_documents(spark):
    rows = queries.op11_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in load(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95 and np.mean([p == y for y, _, p in held]) > 0.93


def test_features_of_single_texts_and_of_many_are_the_same():
    texts = ["", "A b c. D e f!", "x\n\nx\n", "\n", "word " * 50, "été über 中文 " * 9, "###", "a|b | c |", "LOUD!! WORDS!!", "1 22 333", "x" * 5000]
    together = quality.features_of(texts)
    assert np.isfinite(together).all() and not together[0].any()
    for i, t in enumerate(texts):
        assert np.allclose(quality.features_of([t])[0], together[i])
    at = {f: i for i, f in enumerate(quality.FEATURES)}
    assert together[4, at["repeated_next"]] == 49 / 50 and together[8, at["capital_words"]] == 1 and together[6, at["lone_signs"]] == 1


def plain_tree(g, h, n, depth=2):
    """The best splits of bins by trying all; values per bin."""
    score = lambda a, b: a * a / (b + quality.PENALTY)
    best = None
    for k in range(1, len(g)):
        if depth and n[:k].sum() >= quality.MIN_ROWS and n[k:].sum() >= quality.MIN_ROWS:
            gain = score(g[:k].sum(), h[:k].sum()) + score(g[k:].sum(), h[k:].sum()) - score(g.sum(), h.sum())
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                best = (gain, k)
    if best is None:
        return [-g.sum() / (h.sum() + quality.PENALTY)] * len(g)
    k = best[1]
    return plain_tree(g[:k], h[:k], n[:k], depth - 1) + plain_tree(g[k:], h[k:], n[k:], depth - 1)


def test_shallow_trees_and_quadrants_are_the_best_cuts():
    rng = np.random.default_rng(4)
    for _ in range(20):
        n = rng.integers(0, 30, 12)
        g, h = rng.normal(size=12) * n, rng.random(12) * n
        assert np.allclose(quality.shallow_tree(g, h, n), plain_tree(g, h, n))
        g, h = rng.normal(size=(5, 4)), rng.random((5, 4))
        gain, cell = quality.quadrants(g, h)
        every = [sum(p.sum() ** 2 / (q.sum() + quality.PENALTY) for p, q in
                     ((g[:i, :j], h[:i, :j]), (g[:i, j:], h[:i, j:]), (g[i:, :j], h[i:, :j]), (g[i:, j:], h[i:, j:])))
                 for i in range(1, 5) for j in range(1, 4)]
        assert abs(gain + g.sum() ** 2 / (h.sum() + quality.PENALTY) - max(every)) < 1e-9 and len(np.unique(cell.round(12))) <= 4


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit_tables(x, y, rng.random(1500) < 0.2)
    assert (0, 1) in model.pairs
    again = rng.normal(size=(500, 3))
    assert np.mean((model.scores(again) > 0.5) == (again[:, 0] * again[:, 1] > 0)) > 0.9


def test_quality_without_two_kinds_of_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "")], "doc_id long, text string")
    for rows, want in (([], 1.0), ([(1, 1), (2, None)], 1.0), ([(1, 0), (1, 1)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        model = quality.fit_quality(docs, labels)
        assert [r.score for r in quality.score_documents(docs, model).collect()] == [want] * 3
    assert quality.score_documents(docs.limit(0), model).count() == 0


# ------------------------------------------------------------------ hard negatives
def plain_negatives(rows, is_anchor, k_pos, k_neg, low=30, high=90):
    out = []
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        positives = sorted((-s, j) for s, j, m in scored if m == label)[:k_pos]
        for s, j in positives:
            inside = sorted((-t, k, m) for t, k, m in scored if m != label and low * -s <= 100 * t <= high * -s)
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k, _) in enumerate(inside[:k_neg])]
    return sorted(out)


@pytest.mark.parametrize("dim, size, spread", [(16, 40, 0), (7, 40, 5), (1, 3, 0), (33, 10**6, 0), (0, 1, 0)])
def test_hard_negatives_equal_brute_force(spark, dim, size, spread):
    rng = random.Random(dim)
    base = [[rng.randint(-size, size) for _ in range(dim)] for _ in range(4)]
    vectors = [[x + rng.randint(-spread, spread) for x in rng.choice(base)] if spread else [rng.randint(-size, size) for _ in range(dim)] for _ in range(150)]
    rows = [(i, rng.randint(0, 2), v) for i, v in enumerate(vectors)]
    rows += [(200, 1, vectors[3]), (201, 2, vectors[3]), (202, 1, [1, 2])]
    df = spark.createDataFrame(rows + rows[:5] + [(None, 1, vectors[0]), (300, None, vectors[0]), (301, 1, None), (302, 1, [None] * dim or None)],
                               "id long, label int, v array<long>")
    got = hard_negatives.mine(df, F.col("id") % 10 == 0, k_pos=3, k_neg=4, block=20, anchor_block=5).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, lambda i: i % 10 == 0, 3, 4)


def test_bounds_hold_and_drop_rows():
    rng = np.random.default_rng(6)
    centres = rng.integers(-300, 300, size=(10, 64))
    block, other = (hard_negatives.Summary(centres[rng.integers(0, 10, n)] + rng.integers(-50, 50, size=(n, 64))) for n in (500, 20))
    every = np.arange(500)
    for i in range(20):
        exact = block.rows @ other.rows[i]
        widths = []
        for level in range(len(block.levels)):
            low, high = block.bounds(level, every, other, i)
            assert (low <= exact).all() and (exact <= high).all()
            widths.append((high - low).mean())
        assert widths == sorted(widths, reverse=True)
        of, scores = hard_negatives.best_partners(block, other, i, every, 5)
        assert set(np.argsort(-exact)[:5]) <= set(of) and len(of) < 200


def test_hard_negatives_of_nothing_and_of_too_large_scores(spark):
    none = spark.createDataFrame([], "id long, label int, v array<long>")
    assert hard_negatives.mine(none, F.col("id") == 0).count() == 0
    large = spark.createDataFrame([(0, 1, [2**40]), (1, 1, [2**40])], "id long, label int, v array<long>")
    with pytest.raises(Exception, match="62 bits"):
        hard_negatives.mine(large, F.col("id") == 0).collect()
    odd = spark.createDataFrame([([1.0, None],), ([float("nan")],), ([float("inf")],), (None,), ([0.5, -0.001],)], "e array<float>")
    assert [r[0] for r in odd.select(hard_negatives.whole_numbers(F.col("e"))).collect()] == [None, None, None, None, [128, -1]]


# ------------------------------------------------------------------ conversation tries
def plain_trie(sequences):
    """Nodes of {conv: [(role, text), ...]} from all prefixes."""
    members, ends, words = defaultdict(list), defaultdict(list), {(): 0}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                words[tuple(turns[:d])] = len(re.findall(r"[^\x20\x09-\x0D]+", turns[d - 1][1]))
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words[p] + sum(saved[k] for k in kids[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def random_sequences(seed, n=120):
    rng = random.Random(seed)
    turns = [("user", "hello there"), ("assistant", "hi  you\tall"), ("user", ""), ("", "x"), ("user", "a b c"), ("assistant", "a b c"), ("us", "er")]
    base = [[rng.choice(turns) for _ in range(rng.randint(0, 9))] for _ in range(12)]
    return {c * 7 - 100: rng.choice(base)[:rng.randint(0, 9)] + [rng.choice(turns) for _ in range(rng.randint(0, 2))] for c in range(n)}


@pytest.mark.parametrize("seed, task_bytes", [(1, 1 << 20), (2, 300), (3, 2_000), (4, 1)])
def test_trie_equals_all_prefixes(spark, seed, task_bytes):
    sequences = random_sequences(seed)
    rows = [(c, i, *t) for c, s in sequences.items() for i, t in enumerate(s)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    own = conversation_trie.turn_sequences(df)
    empty = spark.createDataFrame([(c, []) for c, s in sequences.items() if not s], own.schema)
    got = conversation_trie.prefix_trie(own.unionByName(empty), task_bytes=task_bytes).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == plain_trie(sequences)


def test_turns_are_ordered_and_nulls_are_empty(spark):
    rows = [(1, 2, "u", "b"), (1, None, None, None), (1, 1, "u", "a"), (2, None, "", ""), (2, 1, "u", "a"), (None, 1, "u", "a"), (3, 5, "u", "b"), (3, 5, "u", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("ids", F.lit(1)).withColumn("id", F.lit(2))
    got = conversation_trie.prefix_trie(conversation_trie.turn_sequences(df)).collect()
    want = plain_trie({1: [("", ""), ("u", "a"), ("u", "b")], 2: [("", ""), ("u", "a")], 3: [("u", "b"), ("u", "b")]})
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == want
    assert conversation_trie.prefix_trie(conversation_trie.turn_sequences(df.limit(0))).count() == 0


def test_nodes_grow_through_all_layouts():
    rng = random.Random(8)
    keys = sorted({bytes([rng.randrange(256), rng.randrange(3)]) * 10 + bytes(rng.randrange(2) for _ in range(20 * rng.randint(0, 2))) for _ in range(700)})
    tree = conversation_trie.RadixTree()
    for i, k in enumerate(rng.sample(keys, len(keys))):
        tree.insert(k, k)
    assert isinstance(tree.root.below, conversation_trie.Full)
    parent, depth, _, values = conversation_trie.turn_nodes(tree)
    assert [values[i] for i in sorted(values)] == keys  # preorder is the order of the keys
    assert len(parent) == 1 + len({k[:i] for k in keys for i in range(20, len(k) + 1, 20)})
    assert all(depth[i] == depth[parent[i]] + 1 for i in range(1, len(parent)))
