"""Token files: ids of documents in patched frame-of-reference blocks.

A file holds the ids of all documents in ascending ``doc_id`` order, cut into
shards (ranges of ids) and segments (a few documents). A segment's ids are cut
into blocks of ``BLOCK`` values. A block stores its minimum, the width in bits
that ``PERCENTILE`` of its differences need, those differences packed at that
width, and the others as exceptions (position and high bits). Beside the packed
bytes stand the blocks' starts, so that any block can be read alone. Segments
are the rows of a Parquet table, written by Spark's committed writer: a lost
executor's half-written segment is never seen, and the file can lie in any
store that Spark reads.

Encoding uses the tokenizers library on distinct pre-tokens; a document's ids
are those of its pre-tokens in order, then the end id. As in the library's
``encode``, a text is cut at the file's added tokens first, which have ids of
their own; the texts between them are cut into pre-tokens each by itself.

Defined results: a null or empty text has the end id alone; a null ``doc_id``
comes after all others; repeated rows are stored each, side by side.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm import pretokens
from lodestar.llm.common import id_key, id_value
from lodestar.session import shared_path

BLOCK = 256
#: Share of a block's differences that fit its width; the rest are exceptions.
PERCENTILE = 0.97
#: Bytes of text that make a segment, about.
SEGMENT = 1_000_000
#: Segments up to which their starts are broadcast.
BROADCAST_ROWS = 500_000
#: Pre-tokens that a worker remembers between batches.
REMEMBERED = 300_000


# ------------------------------------------------------------------ block format
def _lengths(top: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(top.astype(np.float64) + 1)).astype(np.int64)


def pack(values: np.ndarray) -> dict[str, bytes | int]:
    """One segment's values as blocks (see the module's text)."""
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, values[-1] if n else 0, np.int64)
    padded[:n] = values
    grid = padded.reshape(blocks, BLOCK)
    base = grid.min(axis=1) if blocks else np.zeros(0, np.int64)
    rest = grid - base[:, None]
    k = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    width = _lengths(np.partition(rest, k, axis=1)[:, k]) if blocks else np.zeros(0, np.int64)
    high = rest >> width[:, None]
    at = np.flatnonzero(high)
    sizes = BLOCK * width // 8
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = (rest[rows, :, None] >> np.arange(w)) & 1
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        data[starts[rows][:, None] + np.arange(packed.shape[1])] = packed
    return {"n_values": n, "base": base.astype("<u4").tobytes(), "width": width.astype(np.uint8).tobytes(),
            "starts": starts.astype("<u4").tobytes(), "data": data.tobytes(),
            "odd_at": at.astype("<u4").tobytes(), "odd_high": high.reshape(-1)[at].astype("<u4").tobytes()}


def unpack(row: dict[str, bytes | int]) -> np.ndarray:
    """The values of a segment."""
    base, width = np.frombuffer(row["base"], "<u4"), np.frombuffer(row["width"], np.uint8)
    starts, data = np.frombuffer(row["starts"], "<u4"), np.frombuffer(row["data"], np.uint8)
    grid = np.zeros((len(base), BLOCK), np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = data[starts[rows][:, None] + np.arange(BLOCK * int(w) // 8)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, int(w))
        whole = np.zeros((len(rows), BLOCK, 32), np.uint8)
        whole[:, :, :w] = bits
        grid[rows] = np.packbits(whole, axis=2, bitorder="little").view("<u4")[:, :, 0]
    flat = grid.reshape(-1)
    at = np.frombuffer(row["odd_at"], "<u4")
    flat[at] |= np.frombuffer(row["odd_high"], "<u4").astype(np.int64) << width[at // BLOCK].astype(np.int64)
    grid += base[:, None]
    return flat[:row["n_values"]].astype(np.uint32)


# ------------------------------------------------------------------ encoding
class _Encoder:
    """Ids of pre-tokens, by the tokenizers library; remembers the latest distinct ones."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer
        self.library = tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = tokenizer.model
        added = [t for t in json.loads(tokenizer_json).get("added_tokens") or [] if t["content"]]
        # the first match counts, of those the longest
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, contents)))
        self.added = {c: i for i, c in enumerate(contents, 1)}
        self.added_ids = [np.array([tokenizer.token_to_id(c)], np.uint32) for c in contents]
        self.plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        # Fixed rule of byte-level tokenizers: printable bytes stand for themselves, the others for 256 and up.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.signs = {b: signs[b] for b in range(256)}
        self.known: dict[bytes, np.ndarray] = {}

    def cut(self, texts: Sequence[str], end_id: int) -> tuple[list[str], list[int], list[int], list[np.ndarray]]:
        """Texts cut at added tokens: the pieces, the number of the ids that follow each, each text's first piece (plus
        the end) and the ids by number. The end id, number 0, follows a text's last piece."""
        pieces, follow, edges = [], [], [0]
        tails = [np.array([end_id], np.uint32), *self.added_ids]
        for t in texts:
            if not any(c in t for c in self.added):
                pieces.append(t)
            elif self.plain:
                last = 0
                for m in self.marks.finditer(t):
                    pieces.append(t[last:m.start()])
                    follow.append(self.added[m.group()])
                    last = m.end()
                pieces.append(t[last:])
            else:  # tokens that look at or take their neighbours: the library's own rules
                pieces += ["", ""]
                follow.append(len(tails))
                tails.append(np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32))
            follow.append(0)
            edges.append(len(pieces))
        return pieces, follow, edges, tails

    def ids(self, words: list[bytes]) -> list[np.ndarray]:
        known, model, signs = self.known, self.model, self.signs
        if len(known) + len(words) > REMEMBERED:
            known.clear()
        out = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                tokens = model.tokenize(w.decode("latin-1").translate(signs))
                ids = known[w] = np.array([t.id for t in tokens], np.uint32)
            out.append(ids)
        return out


_ENCODERS: dict[int, _Encoder] = {}


def _encoder(tokenizer_json: str) -> _Encoder:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = _Encoder(tokenizer_json)
    return _ENCODERS[key]


def _segments(batches: Iterator[pa.RecordBatch], tokenizer_json: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(tokenizer_json)
    shard = TaskContext.get().partitionId()  # partitions are ranges of ids, in order
    segment = 0
    for batch in batches:
        ids = batch["d"].to_numpy()
        for part in pretokens.runs(batch["text"], SEGMENT):
            lo, hi = part.start, part.stop
            pieces, follow, edges, tails = encoder.cut(pretokens.texts_of(batch["text"].slice(lo, hi - lo)), end_id)
            words, codes, docs = pretokens.split(pieces)
            lists = encoder.ids(words.to_pylist())
            # each piece's pre-tokens, then the ids that follow it (the entries after all words)
            order = np.insert(codes.astype(np.int64), docs[1:], len(lists) + np.array(follow))
            lists = [*lists, *tails]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            values = np.concatenate(lists)
            first = np.concatenate([[0], np.cumsum(lengths)])
            n = lengths[order]
            ends = np.concatenate([[0], np.cumsum(n)])
            stream = values[np.repeat(first[order] - ends[:-1], n) + np.arange(ends[-1])]
            cut = ends[docs + np.arange(len(docs))][edges]
            row = pack(stream)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "segment": pa.array([segment], pa.int64()),
                "doc_ids": pa.array([ids[lo:hi].astype("<i8").tobytes()], pa.binary()),
                "doc_lengths": pa.array([np.diff(cut).astype("<u4").tobytes()], pa.binary()),
                **{k: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for k, v in row.items()}})
            segment += 1


SEGMENT_SCHEMA = ("shard long, segment long, doc_ids binary, doc_lengths binary, n_values long, base binary, "
                  "width binary, starts binary, data binary, odd_at binary, odd_high binary")


def write_token_file(docs: DataFrame, tokenizer_json: str, path: str, end_id: int = 2) -> None:
    """Encode all documents and write their ids to ``path`` in ascending ``doc_id`` order."""
    ordered = (docs.select(id_key().alias("d"), F.coalesce("text", F.lit("")).alias("text"))
                   .repartitionByRange("d").sortWithinPartitions("d"))
    segments = ordered.mapInArrow(lambda it: _segments(it, tokenizer_json, end_id), SEGMENT_SCHEMA)
    segments.write.option("compression", "none").parquet(path)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["doc_ids"], "<i8")
            n = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(n)]) * 4
            data = pa.py_buffer(unpack(row).astype("<u4").tobytes())
            tokens = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), data])
            yield pa.RecordBatch.from_pydict({
                "d": pa.array(ids), "shard": pa.array([row["shard"]] * len(ids), pa.int64()),
                "segment": pa.array([row["segment"]] * len(ids), pa.int64()),
                "place": pa.array((ends[:-1] // 4)), "n_tokens": pa.array(n), "ids": tokens.cast(pa.binary())})


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) of a token file."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # The segment table's own index: a few numbers for about a million characters of text.
    index = segments.select("shard", "segment", "n_values")
    per_shard = index.groupBy("shard").agg(F.sum("n_values").alias("n"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard_start = per_shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    starts = (index.withColumn("inside", F.coalesce(F.sum("n_values").over(inside), F.lit(0)))
                   .join(shard_start, "shard")
                   .select("shard", "segment", (F.col("shard_start") + F.col("inside")).alias("first")))
    if index.count() <= BROADCAST_ROWS:  # a few numbers for each; the documents' ids then stay where they are
        starts = F.broadcast(starts)
    docs = segments.mapInArrow(_read_segments, "d long, shard long, segment long, place long, n_tokens long, ids binary")
    return (docs.join(starts, ["shard", "segment"])
                .select(id_value("d").alias("doc_id"), (F.col("first") + F.col("place")).alias("start"),
                        "n_tokens", "ids"))


def new_path(spark: SparkSession) -> str:
    return shared_path(spark, "llm", "token-file", unique=True)
