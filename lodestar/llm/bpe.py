"""Byte-level BPE: encoding by ranked merges with Spark's higher-order functions, and decoding.

Texts are cut into pre-tokens and the distinct pre-tokens of a run of documents
are put in one row (an Arrow step). A fold over that row's array merges the
pre-tokens: the state is a string with one character per symbol, each step
replaces the pair of the lowest rank, and ranks come from a literal map inside
the plan. A last Arrow step lays the ids of the pre-tokens out in document
order.

The ``COMMON`` most frequent pre-tokens of a sample of ``PRIMER`` documents are
folded once for all tasks and broadcast (their number bounds the size); a task
folds each other pre-token once, until it has seen ``KNOWN`` of them and begins
anew. What is in the sample decides who folds a pre-token, never its ids.
Documents are not shuffled, and memory is bounded by these numbers and by the
run of documents (``CHUNK`` characters, or one longer text).

A pre-token of more than ``LONG`` bytes is folded as overlapping windows, so its
cost grows with its length only. Two windows are joined at a token that both
have at the same place: a sequence of tokens is the encoding of its bytes if
and only if each two neighbours are the encoding of theirs, because the first
merge across a boundary would depend on the two tokens beside it alone. All
neighbours of the joined sequence are neighbours in some window. A pre-token
with windows that share no token is merged with a heap instead.

The rank file's path is a parameter. The map holds pairs of tokens whose
concatenation is a token, so a pair's rank is the joined token's rank, as in
the tiktoken library.

Defined results: a null or empty text has no ids; repeated rows are encoded
alike; every column named in ``keep`` passes through, nulls included.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm import pretokens
from lodestar.llm.common import stored, without

#: Characters of text that share a row.
CHUNK = 2_000_000
#: Distinct pre-tokens that a task remembers from row to row before it begins anew, besides the common ones.
KNOWN = 200_000
#: Documents whose pre-tokens are counted, about, and pre-tokens that all tasks know from the beginning.
PRIMER, COMMON = 20_000, 300_000
#: Bytes of a pre-token that is folded in windows, of the part that a window is for, and of what it has on either side.
LONG, PART, LAP = 192, 64, 32
#: A merged token is the character at its rank plus this; lower characters are single bytes.
FIRST = 256
#: Sorts after every symbol: no rank.
NONE = "\uffff"
#: Symbols up to which a pre-token's pairs are cut out by place; longer ones are split into symbols.
SHORT = 64


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a tiktoken rank file (read on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _symbol(token: bytes, rank: int) -> str:
    return chr(token[0]) if len(token) == 1 else chr(rank + FIRST)


def _pair_buckets(symbol: dict[bytes, str]) -> list[str]:
    """The rank map as strings: bucket h holds ``joined first second`` of each pair with that hash, then ``NONE``.

    A pair is found by searching its bucket. The number of buckets is chosen so that no two neighbouring characters
    of a bucket that are no entry's pair have the bucket's hash as well; so nothing is found by mistake.
    """
    def hashed(pairs: list[str]) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(p.encode(), seed=42) for p in pairs], np.uint64).view(np.int64)

    entries = [symbol[t] + symbol[t[:i]] + symbol[t[i:]] for t in symbol for i in range(1, len(t))
               if t[:i] in symbol and t[i:] in symbol]
    own, before = hashed([e[1:] for e in entries]), hashed([e[:2] for e in entries])
    last = hashed([e[2] + NONE for e in entries])
    for count in range(1 << 16, 1 << 20):
        home = own % count
        if (home == before % count).any() or (home == last % count).any():
            continue
        order = np.argsort(home, kind="stable")
        same = home[order[1:]] == home[order[:-1]]
        joints = [entries[i][2] + entries[k][0] for i, k in zip(order[:-1][same], order[1:][same])]
        if (hashed(joints) % count == home[order[1:][same]]).any():
            continue
        buckets = [""] * count
        for i in order:
            buckets[home[i]] += entries[i]
        return [text + NONE for text in buckets]
    raise ValueError("no number of buckets keeps the pairs apart")


@lru_cache(maxsize=4)
def _tables(path: str) -> tuple[str, int, str, str]:
    """JSON of the rank map's buckets, their number, JSON of the ranks of single bytes, and of all tokens in hex."""
    ranks = read_ranks(path)
    if max(ranks.values()) + FIRST >= 0xD800:
        raise ValueError("too many tokens for one character each")
    symbol = {t: chr(t[0]) if len(t) == 1 else chr(r + FIRST) for t, r in ranks.items()}
    buckets = _pair_buckets(symbol)
    hexes = [""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        hexes[r] = t.hex()
    return json.dumps(buckets), len(buckets), json.dumps([ranks[bytes([i])] for i in range(256)]), json.dumps(hexes)


def _literal(text: str, kind: str) -> Column:
    """A constant array, folded into one literal when the query is planned."""
    return F.from_json(F.lit(text), kind)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_words(words: Column, ranks_path: str) -> Column:
    """``array<binary>`` of pre-tokens to ``array<array<int>>`` of their ids.

    The state of the fold is a string: the pair of neighbours with the lowest rank, as ``joined first second``
    (``NONE`` when no pair has a rank), then the symbols. A step replaces that pair wherever it stands.
    """
    bucket_json, count, byte_json, _ = _tables(ranks_path)
    single = _literal(byte_json, "array<int>")
    places = _literal(json.dumps(list(range(1, SHORT + 1))), "array<int>")
    rest = 2**31 - 1

    def encode_all(ranks: Column) -> Column:
        def look(pair: Column) -> Column:
            bucket = F.get(ranks, F.pmod(F.xxhash64(pair), F.lit(count)).cast("int"))
            return F.substring(bucket, F.instr(bucket, pair) - 1, 3)  # not found: the last character, NONE

        def near(s: Column) -> Column:
            """All pairs, each cut out by its place."""
            return F.transform(F.slice(places, 1, F.length(s) - 1), lambda i: F.substring(s, i, 2))

        def far(s: Column) -> Column:
            """All pairs of a long string."""
            return _let(F.split(s, ""), lambda c: F.zip_with(
                F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.concat(a, b)))

        def merge(s: Column, pairs, steps) -> Column:
            def state(s: Column) -> Column:
                return F.concat(F.coalesce(F.array_min(F.transform(pairs(s), look)), F.lit(NONE)), s)

            def step(z: Column, _: Column) -> Column:
                joined = F.replace(F.substring(z, 4, rest), F.substring(z, 2, 2), F.substring(z, 1, 1))
                return F.when(F.startswith(z, F.lit(NONE)), z).otherwise(_let(joined, state))

            return F.aggregate(steps(s), state(s), step)  # each step but the last ones merges, so there are enough

        def encode(word: Column) -> Column:
            merged = _let(F.decode(word, "ISO-8859-1"),  # one character per byte
                          lambda s: F.when(F.length(s) <= SHORT, merge(s, near, lambda s: F.slice(places, 1, F.length(s) - 1)))
                          .otherwise(merge(s, far, lambda s: F.sequence(F.lit(1), F.length(s)))))
            code = F.ascii
            return F.transform(F.split(F.substring(merged, 2, rest), ""), lambda c: F.when(
                code(c) < FIRST, F.get(single, code(c))).otherwise(code(c) - FIRST))

        return F.transform(words, encode)

    return _let(_literal(bucket_json, "array<string>"), encode_all)


def decode_words(words: Column, ranks_path: str) -> Column:
    """``array<array<int>>`` of ids to ``array<binary>``: the bytes of their tokens, put together."""
    return _let(_literal(_tables(ranks_path)[3], "array<string>"), lambda pieces: F.transform(
        words, lambda ids: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))))


# ------------------------------------------------------------------ long pre-tokens
def windows(word: bytes, part: int = PART, lap: int = LAP) -> list[tuple[int, bytes]]:
    """Overlapping parts of a word, with their places."""
    return [(max(0, a - lap), word[max(0, a - lap):a + part + lap]) for a in range(0, len(word), part)]


def join_windows(parts: Sequence[tuple[int, np.ndarray]], length_of: np.ndarray) -> np.ndarray | None:
    """The ids of a word from its windows' (place, ids); None if two neighbours have no token in common."""
    out, cut = [], 0  # tokens from ``cut`` on are still to come
    for k, (at, ids) in enumerate(parts):
        edges = at + np.concatenate([[0], np.cumsum(length_of[ids])])
        begin = int(np.searchsorted(edges, cut))
        if k + 1 == len(parts):
            out.append(ids[begin:])
            break
        next_at, next_ids = parts[k + 1]
        next_edges = next_at + np.concatenate([[0], np.cumsum(length_of[next_ids])])
        # a token is the same in both if it starts and ends at the same places
        mine, other = edges[begin:-1] * 65536 + np.diff(edges[begin:]), next_edges[:-1] * 65536 + np.diff(next_edges)
        same = np.flatnonzero(np.isin(mine, other))
        if not len(same):
            return None
        last = begin + int(same[len(same) // 2])
        out.append(ids[begin:last + 1])
        cut = int(edges[last + 1])
    return np.concatenate(out)


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word by ranked merges with a heap; for stretches whose windows don't meet."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(word[a:end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


# ------------------------------------------------------------------ operator
class Known(NamedTuple):
    """The pre-tokens that all tasks know: the words, which are also their decoded bytes, their ids in a row and how many."""

    words: pa.Array
    values: np.ndarray
    lengths: np.ndarray


def _pack(batches: Iterator[pa.RecordBatch], keep: Sequence[str], size: int, limit: int, common) -> Iterator[pa.RecordBatch]:
    base = {w: i for i, w in enumerate(common.value.words.to_pylist())}
    known: dict[bytes, int] | None = None
    for batch in batches:
        for part in pretokens.runs(batch["text"], size):
            mine = batch.slice(part.start, part.stop - part.start)
            words, codes, docs = pretokens.split(pretokens.texts_of(mine["text"]))
            listed = words.to_pylist()
            long = [i for i, w in enumerate(listed) if len(w) > LONG]
            cut = [windows(listed[i]) for i in long]
            whole = [w for w in listed if len(w) <= LONG] + list(dict.fromkeys(w for parts in cut for _, w in parts))
            new = [w for w in whole if w not in known] if known else whole
            anew = known is None or len(known) - len(base) + len(new) > limit
            if anew:
                known = dict(base)
                new = [w for w in whole if w not in known]
            new = list(dict.fromkeys(new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            number = np.fromiter((known[w] if len(w) <= LONG else -1 for w in listed), np.int32, len(listed))
            number[long] = -1 - np.arange(len(long), dtype=np.int32)
            row = {c: _one_list(mine[c]) for c in keep}
            row["words"] = _one_list(pa.array(new, pa.binary()))
            row["codes"] = pa.array([number[codes].tobytes()], pa.binary())
            row["docs"] = pa.array([docs.astype(np.int64).tobytes()], pa.binary())
            row["anew"] = pa.array([anew])
            row["windows"] = pa.array([[[x for at, w in parts for x in (at, known[w])] for parts in cut]], pa.list_(pa.list_(pa.int64())))
            del words, codes, docs, listed, whole, new, number, cut  # what follows waits for the next step, with this in memory
            yield pa.RecordBatch.from_pydict(row)
            del row
            pa.default_memory_pool().release_unused()


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _joined(parts: Sequence[int], first: np.ndarray, lengths: np.ndarray, values: np.ndarray, texts: pa.Array, tokens) -> np.ndarray:
    """The ids of a long pre-token from its windows (place, number, place, number, ...)."""
    found = [(at, values[first[w]:first[w] + lengths[w]]) for at, w in zip(parts[::2], parts[1::2])]
    ids = join_windows(found, tokens.value[0])
    if ids is None:
        word = b""
        for at, w in zip(parts[::2], parts[1::2]):
            word = word[:at] + texts[w].as_py()
        ids = np.array(merge_bytes(word, {t: r for r, t in enumerate(tokens.value[1]) if t is not None}), np.int64)
    return ids


def _lay_out(batches: Iterator[pa.RecordBatch], keep: Sequence[str], common, tokens, step: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    start = common.value
    base = start.words
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for r in range(batch.num_rows):
            lists, pieces = batch["ids"][r].values, batch["bytes"][r].values.cast(pa.large_binary())
            new_values, new_lengths = np.asarray(lists.flatten()), np.asarray(pc.list_value_length(lists))
            if batch["anew"][r].as_py():
                values, lengths, texts = start.values, start.lengths, base
            values, lengths = np.concatenate([values, new_values]), np.concatenate([lengths, new_lengths])
            texts = pa.concat_arrays([texts, pieces])
            first = np.concatenate([[0], np.cumsum(lengths)])
            codes = np.frombuffer(batch["codes"][r].as_py(), np.int32)
            docs = np.frombuffer(batch["docs"][r].as_py(), np.int64)
            all_values, all_lengths, all_texts = values, lengths, texts
            if long := batch["windows"][r].as_py():  # these are numbered after the known ones
                whole = [_joined(parts, first, lengths, values, texts, tokens) for parts in long]
                decoded = [b"".join(tokens.value[1][i] for i in ids) for ids in whole]
                all_values = np.concatenate([values, *whole])
                all_lengths = np.concatenate([lengths, [len(ids) for ids in whole]])
                all_texts = pa.concat_arrays([texts, pa.array(decoded, pa.large_binary())])
                first = np.concatenate([[0], np.cumsum(all_lengths)])
                codes = np.where(codes < 0, len(lengths) - 1 - codes, codes)
            carried = {c: batch[c][r].values for c in keep}
            a = 0
            while a < len(docs) - 1:  # documents with about ``step`` pre-tokens together
                b = max(a + 1, int(np.searchsorted(docs, docs[a] + step, "right")) - 1)
                mine = codes[docs[a]:docs[b]]
                n = all_lengths[mine]
                ends = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(first[mine] - ends[:-1], n) + np.arange(ends[-1])
                bounds = docs[a:b + 1] - docs[a]
                ids = pa.py_buffer(all_values[at].astype("<u4").tobytes())
                taken = all_texts.take(pa.array(mine))
                place = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
                out = {c: carried[c].slice(a, b - a) for c in keep}
                for name, cut, data in (("ids", 4 * ends[bounds], ids), ("decoded", place[bounds], taken.buffers()[2])):
                    out[name] = pa.Array.from_buffers(
                        pa.large_binary(), b - a, [None, pa.py_buffer(cut.astype(np.int64)), data]).cast(pa.binary())
                yield pa.RecordBatch.from_pydict(out)
                a = b


def _counted(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pretokens.runs(batch["text"], size):
            words, codes, _ = pretokens.split(pretokens.texts_of(batch["text"].slice(part.start, part.stop - part.start)))
            short = np.flatnonzero(np.asarray(pc.binary_length(words)) <= LONG)
            yield pa.RecordBatch.from_pydict({
                "word": words.take(pa.array(short)).cast(pa.binary()),
                "n": pa.array(np.bincount(codes, minlength=len(words))[short].astype(np.int64))})


def common_words(docs: DataFrame, ranks_path: str, primer: int = PRIMER, limit: int = COMMON, chunk: int = CHUNK) -> Known:
    """The ``limit`` most frequent pre-tokens of about ``primer`` documents, folded; without a limit above 0 none, and no job."""
    if limit <= 0:
        return Known(pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(0, np.int32))
    share = min(1.0, primer / max(docs.count(), 1))
    counts = (docs.select("text").sample(share, seed=7).mapInArrow(lambda it: _counted(it, chunk), "word binary, n long")
                  .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(limit))
    # stored first: a plan that holds the ranks has no exchange, so it is planned once and the driver keeps one of it
    lists = stored(counts.groupBy(F.pmod(F.xxhash64("word"), F.lit(64)).alias("part")).agg(F.collect_list("word").alias("words"))
                         .repartition(32, "part"), "common-words")
    folded = lists.select("words", encode_words(F.col("words"), ranks_path).alias("ids"))
    rows = folded.select("words", "ids", decode_words(F.col("ids"), ranks_path).alias("pieces")).toArrow()  # ``limit`` words at most
    words, ids, pieces = (pc.list_flatten(rows[c].combine_chunks()) for c in ("words", "ids", "pieces"))
    if not words.equals(pieces):
        raise ValueError("some pre-tokens don't decode to themselves")
    return Known(words.cast(pa.large_binary()), np.asarray(pc.list_flatten(ids), np.int32), np.asarray(pc.list_value_length(ids), np.int32))


def encode_documents(docs: DataFrame, ranks_path: str, keep: Sequence[str] = ("doc_id",),
                     chunk: int = CHUNK, known: int = KNOWN, primer: int = PRIMER, common: int = COMMON) -> DataFrame:
    """Columns ``keep`` of each row with ``ids`` (little-endian unsigned 32-bit) and ``decoded`` (bytes of the ids).

    ``keep`` may hold ``text`` itself. ``common`` = 0 leaves every pre-token to the tasks: more folding, but one plan
    with the ranks less in the driver's memory.
    """
    names = without(keep, ("ids", "decoded"))
    kept = [f"k{i}" for i in range(len(names))]  # out of the way of the columns that follow
    kinds = [docs.schema[c].dataType for c in names]
    fields = [*("words codes docs anew windows".split())]
    packed = T.StructType([T.StructField(k, T.ArrayType(t)) for k, t in zip(kept, kinds)]
                          + [T.StructField(f, t) for f, t in zip(fields, (
                              T.ArrayType(T.BinaryType()), T.BinaryType(), T.BinaryType(), T.BooleanType(),
                              T.ArrayType(T.ArrayType(T.LongType()))))])
    laid = T.StructType([*(T.StructField(k, t) for k, t in zip(kept, kinds)),
                         T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    sc = docs.sparkSession.sparkContext
    ranks = read_ranks(ranks_path)
    by_rank: list = [None] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        by_rank[i] = t
    tokens = sc.broadcast((np.array([len(t or b"") for t in by_rank], np.int64), by_rank))
    shared = sc.broadcast(common_words(docs, ranks_path, primer, common, chunk))
    runs = (docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)), F.col("text").alias("text"))
                .mapInArrow(lambda it: _pack(it, kept, chunk, known, shared), packed))
    coded = runs.withColumn("ids", encode_words(F.col("words"), ranks_path))
    both = coded.select(*kept, "codes", "docs", "anew", "windows", "ids", decode_words(F.col("ids"), ranks_path).alias("bytes"))
    return both.mapInArrow(lambda it: _lay_out(it, kept, shared, tokens), laid).toDF(*names, "ids", "decoded")
