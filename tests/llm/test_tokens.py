"""Pre-tokens, byte-level BPE, token files and unigram token counts against plain versions."""

import functools
import json
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestar.llm import bpe, pretokens, token_counts, token_file

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["Hello world, it's we'll 'tis  \n\n x\t", "", None, "and" + "a" * 300, "é 漢字 😀  end \x85", " " * 70,
       "repeat", "repeat", "x\r\n", "12345 67", "don't'S've '"]
SCHEMA = "doc_id long, text string, ids string, words string, d long"


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "ids!", None, -i) for i, t in enumerate(ODD)] + [(None, "no id", "", "w", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@given(st.lists(st.text(alphabet="ab sS'tredvlmxyz  \n\t12.!é漢　 😀\x85-", max_size=40), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_pretokens_are_the_patterns_matches(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    words, codes, docs = pretokens.split(texts)
    listed = [w.decode() for w in words.to_pylist()]
    assert [[listed[k] for k in codes[docs[i]:docs[i + 1]]] for i in range(len(texts))] == [pattern.findall(t) for t in texts]


def test_bpe_equals_tiktoken_and_decodes(spark, odd_docs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    out = bpe.encode_documents(odd_docs, RANKS, keep=["doc_id", "text", "words"], chunk=60, known=20).collect()
    assert len(out) == len(ODD) + 1
    for r in out:
        assert np.frombuffer(r[3], "<u4").tolist() == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_bpe_of_random_bytes(spark):
    rng = random.Random(5)
    words = [bytes(rng.choice(b"aeinst hr\xc3\xa9\x00\xff") for _ in range(rng.randint(1, 90))) for _ in range(300)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    df = spark.createDataFrame([([bytearray(w) for w in words],)], "words array<binary>")
    coded = df.withColumn("ids", bpe.encode_words(df.words, RANKS))
    got = coded.withColumn("back", bpe.decode_words(coded.ids, RANKS)).first()
    assert [bytes(b) for b in got.back] == words
    assert [list(i) for i in got.ids] == [library._core_bpe.encode_single_piece(w) for w in words]


LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def long_words():
    rng = random.Random(3)
    words = ["".join(rng.choice(LETTERS) for _ in range(n)) for n in (191, 193, 700, 5_000, 100_000)]
    words += ["a" * 3_001, "=" * 5_003, "abc" * 1_001, "the" * 900 + "The" * 77, "\u00e9\u4e2d" * 400, "z" * 193]
    words += ["".join(rng.choice(["tion", "ing", "er", "the", "q"]) for _ in range(300)) for _ in range(40)]
    return words


def test_bpe_without_common_words(spark, odd_docs):
    with_common = bpe.encode_documents(odd_docs, RANKS, keep=["doc_id", "text"], chunk=60, known=20).collect()
    assert sorted(map(repr, bpe.encode_documents(odd_docs, RANKS, keep=["doc_id", "text"], chunk=60, common=0).collect())) == sorted(map(repr, with_common))


def test_bpe_of_long_words(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = long_words() + ["one " + " ".join(long_words()[2:4]) + " two"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in bpe.encode_documents(df, RANKS, keep=["doc_id", "text"], chunk=10_000, known=50).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"])
        assert bytes(r["decoded"]) == r["text"].encode()


def test_windows_without_a_common_token_are_merged_with_a_heap():
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in long_words():
        assert bpe.merge_bytes(word.encode(), ranks) == library._core_bpe.encode_single_piece(word.encode())
    lengths = np.array([len(t) for t, _ in sorted(ranks.items(), key=lambda x: x[1])])
    once = np.array(library._core_bpe.encode_single_piece(b"tion"))
    assert bpe.join_windows([(0, once), (2, once)], lengths) is None


def test_bpe_of_an_empty_table(spark):
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), RANKS).count() == 0


@pytest.mark.parametrize("values", [[], [7], [0] * 600, list(range(1000)), [3, 50256] * 300 + [2**32 - 1]])
def test_blocks_round_trip(values):
    values = np.array(values, np.uint32)
    assert (token_file.unpack(token_file.pack(values)) == values).all()


@given(st.lists(st.integers(0, 2**32 - 1), max_size=700))
@settings(max_examples=50, deadline=None)
def test_blocks_round_trip_any(values):
    values = np.array(values, np.uint32)
    assert (token_file.unpack(token_file.pack(values)) == values).all()


def test_a_block_can_be_read_alone():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50_000, 2_000).astype(np.uint32)
    row = token_file.pack(values)
    starts, width = np.frombuffer(row["starts"], "<u4"), np.frombuffer(row["width"], np.uint8)
    assert (np.diff(starts) == width.astype(int) * token_file.BLOCK // 8).all() and starts[-1] == len(row["data"])


def test_token_file_holds_the_librarys_ids_in_order(spark, odd_docs):
    with open(JSON, encoding="utf-8") as f:
        text = f.read()
    path = token_file.new_path(spark)
    token_file.write_token_file(odd_docs, text, path, end_id=2)
    got = {r.doc_id: r for r in token_file.read_token_file(spark, path).collect()}
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    start = 0
    for i, t in [*enumerate(ODD), (None, "no id")]:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        data = np.array(ids, "<u4").tobytes()
        assert (got[i].start, got[i].n_tokens, zlib.crc32(bytes(got[i].ids))) == (start, len(ids), zlib.crc32(data))
        start += len(ids)


MARK = "<|endoftext|>"
MARKED = [MARK, f"{MARK} start", f"end of one {MARK} start", f"at the end  {MARK}", f"{MARK}{MARK}\n\n{MARK} é 漢", "<|endof", None,
          f"it{MARK}'s {MARK[1:]} <|{MARK}|>", "after", f"  {MARK}  "]


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"single_word": True, "rstrip": True}, {"normalized": True}])
def test_token_file_holds_added_tokens(spark, flags):
    with open(JSON, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0].update(flags)
    text, path = json.dumps(spec), token_file.new_path(spark)
    token_file.write_token_file(spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string"), text, path, end_id=2)
    got = {r.doc_id: r for r in token_file.read_token_file(spark, path).collect()}
    library, start = Tokenizer.from_str(text), 0
    for i, t in enumerate(MARKED):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, np.frombuffer(got[i].ids, "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)


@given(st.lists(st.sampled_from(["<|a|>", "<|a|><|b|>", "|>", "<|", "a", " ", "'s", "\n", "é", MARK]), max_size=12).map("".join))
@settings(max_examples=200, deadline=None)
def test_cuts_at_added_tokens_are_the_librarys(text):
    library, encoder = _two_marks()
    pieces, follow, edges, tails = encoder.cut([text], 2)
    got = [i for p, f in zip(pieces, follow) for i in [*library.encode(p).ids, *tails[f].tolist()]]
    assert edges == [0, len(pieces)] and got == [*library.encode(text).ids, 2]


@functools.lru_cache(maxsize=1)
def _two_marks():
    with open(JSON, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"] += [spec["added_tokens"][0] | {"id": 50257 + i, "content": c} for i, c in enumerate(["<|a|>", "<|a|><|b|>"])]
    text = json.dumps(spec)
    return Tokenizer.from_str(text), token_file._Encoder(text)


def test_token_file_of_an_empty_table(spark):
    path = token_file.new_path(spark)
    with open(JSON, encoding="utf-8") as f:
        token_file.write_token_file(spark.createDataFrame([], SCHEMA), f.read(), path)
    assert token_file.read_token_file(spark, path).count() == 0


def best_count(word, scores):
    """Token count of the best cut, by trying all."""
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        options = [(best[b][0] + scores[word[b:end]], best[b][1] + 1) for b in range(end) if word[b:end] in scores]
        top = max(o[0] for o in options)
        best[end] = (top, min(o[1] for o in options if o[0] == top))
    return best[len(word)][1]


@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=40))
@settings(max_examples=100, deadline=None)
def test_trie_counts_equal_separate_counts(words):
    scores = {t: -math.log(i + 1.5) for i, t in enumerate([b"ab", b"abc", b"a", b"b", b"c", b"bca", b"cc", b"aab"])}
    words = sorted(set(words))
    assert token_counts.terminal_counts(words, scores, 3) == [best_count(w, scores) if w else 0 for w in words]


def test_counts_of_documents(spark, odd_docs):
    scores = token_counts.zipf_scores(bpe.read_ranks(RANKS))
    pattern = regex.compile(public_tokenizers.PATTERN)
    got = token_counts.count_tokens(odd_docs, RANKS, keep=["doc_id", "text"]).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        words = pattern.findall(r["text"] or "")
        assert r.n_pretokens == len(words)
        assert r.n_tokens == sum(best_count(w.encode(), scores) for w in words)
