"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id has ``TURN`` bytes: 16 of the SHA-256 of its role and text, then the
number of its words. A conversation is the byte string of its turns' ids, so a
sequence of turns is a prefix at a multiple of ``TURN`` bytes, and the trie of
turns lies inside the radix tree of bytes.

1. Conversations of equal turns become one key with their number, their smallest
   id and the digest of their ids. Ids are sorted over all tasks and hashed in
   pieces, so a sequence that a third of all conversations share is no group in
   memory.
2. Distinct keys are dealt out by range and sorted. A task builds one adaptive
   radix tree over its keys: nodes hold 4, 16, 48 or 256 children, grow when
   full, and compress paths; only byte depths that end a turn emit a node.
3. A node is complete unless it is a prefix of its task's first or last key (an
   *open* node: other tasks may hold members of it). Open nodes of all tasks
   are added up by their path. Their subtrees are intervals of the trie's
   preorder, so sums over a subtree are differences of running sums over the
   tasks' chains of open nodes.

A task holds ``task_bytes`` of keys (or one longer key); open nodes are at most
two chains per task; a conversation's ids (``TURN`` bytes a turn, no texts) are
one row.

Defined results: rows without a conversation id take no part; a null role or
text is the empty one; turns come in the order of ``turn``, null first, and
equal ones in the order of their digests (so repeated rows are turns of their
own, next to each other); a conversation without turns is a member of the root
alone; an empty table has no nodes. Texts of any length are hashed whole. Only
the columns named are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import stored

#: Bytes of a turn id: a digest, then the number of words.
DIGEST, TURN = 16, 20
#: Bytes of keys in a task's tree.
TASK_BYTES = 16 << 20
#: Rows of a batch that a task hands on.
BATCH = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------------ turns to keys
def turn_id(role: Column, text: Column) -> Column:
    """``TURN`` bytes: digest of (role, text), then the number of words, big-endian."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 2 * (TURN - DIGEST), "0")
    return F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), words))


def turn_sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv, ids): each conversation's turn ids in order."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("id"))
    listed = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    return listed.select("conv", F.transform("turns", lambda t: t["id"]).alias("ids"))


def joined(ids: Column) -> Column:
    """The ids of an array as one byte string."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.hex(i)), ""))


# ------------------------------------------------------------------ equal sequences
def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys within a batch: the ids, comma-joined."""
    for batch in batches:
        digests, keys = batch["digest"].to_pylist(), batch["key"]
        ids = batch["conv"].to_pylist()
        cuts = [i for i in range(len(ids)) if not i or digests[i] != digests[i - 1]] + [len(ids)]
        runs = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_pydict({
            "digest": pa.array([digests[a] for a, _ in runs], pa.binary()), "key": keys.take(pa.array(cuts[:-1], pa.int64())),
            "first": pa.array([ids[a] for a, _ in runs], pa.int64()), "n": pa.array([b - a for a, b in runs], pa.int64()),
            "listed": pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string())})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from its pieces, which come one after the other in the order of their ids."""
    digest = key = first = n = sha = None
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ends", pa.string()))
        return pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(kinds)})

    for batch in batches:
        for row in zip(*(batch[c] for c in ("digest", "key", "first", "n", "listed"))):
            d, k, f, m, listed = (v.as_py() for v in row)
            if d != digest:
                if sha is not None:
                    out.append((key, first, n, sha.hexdigest()))
                digest, key, first, n, sha = d, k, f, 0, hashlib.sha256()
            else:
                sha.update(b",")
            n += m
            sha.update(listed.encode())
            if len(out) >= BATCH:
                yield batch_of(out)
                out = []
    if sha is not None:
        out.append((key, first, n, sha.hexdigest()))
    if out:
        yield batch_of(out)


def distinct_keys(sequences: DataFrame) -> DataFrame:
    """(key, first, n, ends): each distinct sequence with its conversations; ``ends`` hashes their ids."""
    keyed = sequences.select("conv", joined(F.col("ids")).alias("key"))
    keyed = stored(keyed.withColumn("digest", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * DIGEST))), "trie-keys")
    pieces = (keyed.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
                   .mapInArrow(_pieces, "digest binary, key binary, first long, n long, listed string"))
    return stored(pieces.repartition("digest").sortWithinPartitions("digest", "first")
                        .mapInArrow(_ends, "key binary, first long, n long, ends string"), "trie-distinct")


# ------------------------------------------------------------------ adaptive radix tree
class Few:
    """Up to 4 or 16 children: their bytes, sorted, beside them."""

    __slots__ = ("size", "bytes", "kids")

    def __init__(self, size: int = 4, parts: tuple[bytearray, list] | None = None):
        self.size = size
        self.bytes, self.kids = parts or (bytearray(), [])

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid) -> Few | Indexed:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.size:
            return (Few(16, (self.bytes, self.kids)) if self.size == 4 else Indexed(self)).put(byte, kid)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def ordered(self) -> list:
        return self.kids


class Indexed:
    """Up to 48 children: a table of all bytes gives their places."""

    __slots__ = ("places", "kids")

    def __init__(self, few: Few):
        self.places, self.kids = bytearray(256), list(few.kids)
        for i, byte in enumerate(few.bytes):
            self.places[byte] = i + 1

    def get(self, byte: int):
        at = self.places[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid) -> Indexed | Full:
        at = self.places[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) == 48:
            return Full(self).put(byte, kid)
        self.kids.append(kid)
        self.places[byte] = len(self.kids)
        return self

    def ordered(self) -> list:
        return [self.kids[at - 1] for at in self.places if at]


class Full:
    """A place for every byte."""

    __slots__ = ("kids",)

    def __init__(self, indexed: Indexed):
        self.kids = [indexed.get(byte) for byte in range(256)]

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> Full:
        self.kids[byte] = kid
        return self

    def ordered(self) -> list:
        return [k for k in self.kids if k is not None]


class Node:
    """``path``: the bytes from the parent's end to this node's end, the branching byte first."""

    __slots__ = ("path", "value", "below")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.below = path, value, None

    def put(self, kid: Node) -> None:
        self.below = (self.below or Few()).put(kid.path[0], kid)


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many first bytes of ``a`` stand in ``b`` from ``at`` on."""
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[at:at + mid] else (low, mid - 1)
    return low


class RadixTree:
    """Byte strings with values; a string may be a prefix of another."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        above, node, at = None, self.root, 0
        while True:
            same = _common(node.path, key, at)
            if same < len(node.path):  # the compressed path splits
                upper = Node(node.path[:same])
                node.path = node.path[same:]
                upper.put(node)
                above.put(upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            kid = node.below.get(key[at]) if node.below else None
            if kid is None:
                node.put(Node(key[at:], value))
                return
            above, node = node, kid


def turn_nodes(tree: RadixTree) -> tuple[array, array, array, dict[int, object]]:
    """The nodes at turns' ends in preorder: parent's place, depth and words, and the values by place."""
    parent, depth, words, values = array("q", [-1]), array("q", [0]), array("q", [0]), {}
    stack = [(tree.root, 0, 0, b"")]
    while stack:
        node, start, here, begun = stack.pop()
        data = begun + node.path
        before, turns = start // TURN, len(data) // TURN
        for t in range(1, turns + 1):
            parent.append(here)
            depth.append(before + t)
            words.append(int.from_bytes(data[TURN * t - (TURN - DIGEST):TURN * t], "big"))
            here = len(parent) - 1
        if node.value is not None:
            values[here] = node.value
        if node.below:
            end, rest = start + len(node.path), data[TURN * turns:]
            stack.extend((kid, end, here, rest) for kid in reversed(node.below.ordered()))
    return parent, depth, words, values


# ------------------------------------------------------------------ a task's nodes
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, words long, task int, side int, right boolean, path binary, parent_path binary, parent_side int")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _paths(key: bytes) -> list[bytes]:
    """A digest of each prefix of whole turns."""
    sha, out = hashlib.sha256(), []
    out.append(sha.digest()[:DIGEST])
    for at in range(0, len(key), TURN):
        sha.update(key[at:at + TURN])
        out.append(sha.digest()[:DIGEST])
    return out


def _task_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's sorted keys. Open ones have a ``path``; their counts leave out open nodes below them."""
    tree, first, last = RadixTree(), None, b""
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("key", "first", "n", "ends"))):
            tree.insert(row[0], row[1:])
            first, last = row[0] if first is None else first, row[0]
    if first is None:
        return
    task = TaskContext.get().partitionId()
    parent, depth, words, values = turn_nodes(tree)
    del tree
    size = len(parent)
    left, right = _paths(first), _paths(last)
    spine = [-1] * len(right)  # places of the last key's prefixes
    at = size - 1
    while at >= 0:
        spine[depth[at]] = at
        at = parent[at]
    on_right = set(spine)
    path = {at: left[depth[at]] for at in range(len(left))} | {at: right[depth[at]] for at in spine}
    n, low = array("q", bytes(8 * size)), array("q", [2**63 - 1]) * size
    kids, leaves, saved = (array("q", bytes(8 * size)) for _ in range(3))
    for at in range(size - 1, -1, -1):
        if at in values:
            n[at] += values[at][1]
            low[at] = min(low[at], values[at][0])
        up = parent[at]
        if at not in path:
            leaves[at] += not kids[at]
            saved[at] += (n[at] - 1) * words[at]
            kids[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
        if up >= 0:
            n[up] += n[at]
            low[up] = min(low[up], low[at])
    for begin in range(0, size, BATCH):
        part = range(begin, min(begin + BATCH, size))
        up = [parent[at] for at in part]
        open_ = [at in path for at in part]
        columns = {
            "conv_id": low[begin:part.stop], "depth": depth[begin:part.stop],
            "parent_conv_id": [low[p] if p >= 0 and p not in path else None for p in up],
            "n_convs": n[begin:part.stop], "n_children": kids[begin:part.stop], "n_leaves": leaves[begin:part.stop],
            "saved_tokens": saved[begin:part.stop],
            "ends_sha256": [values[at][2] if at in values else None if o else NO_ENDS for at, o in zip(part, open_)],
            "words": words[begin:part.stop], "task": [task] * len(part),
            "side": [int(at >= len(left)) if o else None for at, o in zip(part, open_)],
            "right": [at in on_right if o else None for at, o in zip(part, open_)],
            "path": [path.get(at) for at in part],
            "parent_path": [path.get(p) if o else None for p, o in zip(up, open_)],
            "parent_side": [int(p >= len(left)) if p in path else None for p in up]}
        kinds = {"ends_sha256": pa.string(), "path": pa.binary(), "parent_path": pa.binary(), "task": pa.int32(),
                 "side": pa.int32(), "parent_side": pa.int32(), "right": pa.bool_()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()})


# ------------------------------------------------------------------ open nodes
def _merged(rows: DataFrame) -> DataFrame:
    """The open nodes of all tasks, each once, with counts over their whole subtrees."""
    nodes = rows.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_path").alias("parent_path"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("ends_sha256").alias("ends"), F.max("words").alias("words"),
        F.min(F.struct("task", "side")).alias("home"), F.max(F.struct("task", "right")).alias("last"))
    nodes = stored(nodes, "trie-open")
    below = nodes.where(F.col("parent_path").isNotNull()).groupBy(F.col("parent_path").alias("path")).agg(
        F.count(F.lit(1)).alias("open_kids"))
    nodes = (nodes.join(below, "path", "left")
                  .withColumn("n_children", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
                  .withColumn("leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long"))
                  .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words"))
                  .withColumn("chain", F.col("home.task") * 2 + F.col("home.side"))
                  .withColumn("stop", F.col("last.task") * 2 + F.col("last.right").cast("int")))
    deeper = Window.partitionBy("chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    nodes = stored(nodes.withColumns({f"in_{c}": F.sum(c).over(deeper) for c in ("leaves", "saved")}), "trie-chains")
    totals = nodes.groupBy("chain").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    chains = (rows.select("task").distinct().select(F.explode(F.array(F.col("task") * 2, F.col("task") * 2 + 1)).alias("chain"))
                  .join(totals, "chain", "left").fillna(0, ["leaves", "saved"]))
    so_far = Window.orderBy("chain").rowsBetween(Window.unboundedPreceding, 0)  # two rows a task
    chains = stored(chains.select("chain", *(F.sum(c).over(so_far).alias(f"to_{c}") for c in ("leaves", "saved"))), "trie-sums")
    begin = chains.toDF("chain", "leaves_0", "saved_0")
    end = chains.toDF("stop", "leaves_1", "saved_1")
    parents = nodes.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(begin, "chain").join(end, "stop").join(parents, "parent_path", "left").select(
        "path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("in_leaves") + F.col("leaves_1") - F.col("leaves_0")).alias("n_leaves"),
        (F.col("in_saved") + F.col("saved_1") - F.col("saved_0")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(sequences: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per node of the trie of (conv, ids): ids are arrays of turn ids.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 (of the ids of the conversations
    that end here).
    """
    keys = distinct_keys(sequences)
    total = keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    tasks = max(1, math.ceil(total / task_bytes))
    nodes = (keys.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(_task_nodes, _NODE))
    nodes = stored(nodes, "trie-nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = nodes.where(F.col("path").isNotNull())
    merged = stored(_merged(rows), "trie-merged")
    closed = nodes.where(F.col("path").isNull())
    whole = closed.where(F.col("parent_side").isNull()).select(*columns)
    # a complete node under an open one takes its parent's smallest member from all tasks; a task's own rows meet here only
    found = (rows.join(merged.select("path", F.col("conv_id").alias("found")), "path")
                 .select("task", F.col("side").alias("parent_side"), F.col("depth").alias("parent_depth"), "found"))
    under = (closed.where(F.col("parent_side").isNotNull()).withColumn("parent_depth", F.col("depth") - 1)
                   .join(found, ["task", "parent_side", "parent_depth"])
                   .withColumn("parent_conv_id", F.col("found")).select(*columns))
    return merged.select(*columns).union(whole).union(under)
