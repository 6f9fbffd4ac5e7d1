"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

A document's shingles are the distinct runs of ``N`` words (all its words, if
fewer); words are runs of ASCII letters and digits and of non-ASCII characters
in lower case. Documents with the same shingles form a class, named by its
smallest ``doc_id``; only classes are compared.

Each class has ``TREES`` labels of ``DEPTH`` MinHash values. A tree of the
forest is the sorted sequence of the labels, in which a run of labels that
agree on a prefix is a subtrie. Prefixes are matched at full depth and
shortened one value at a time until a pair at the threshold itself meets in some
tree with the target probability: a pair of similarity s agrees on d values in
one of L trees with ``1 - (1 - s**d)**L``, and more similar pairs meet more
often. The depth so follows from the parameters alone; no row is sampled for
it. Members of a subtrie at that depth are candidates. The same set of
members in several trees is looked at once.

Candidates whose signatures agree in less than ``threshold - MARGIN`` (more
than five standard deviations below) are dropped; the others form families,
inside which all pairs whose signatures agree so far are verified exactly from
their shingles. Large subtries and families are cut into blocks of ``BLOCK``
members and compared block against block, so no task holds a group; a task
returns a member's number of links and a spanning forest of its links, never the
list of pairs. Classes are numbered, not hashed, so no two of them share a name.

Defined results: a text without words (null, empty) is a class of its own per
document and has no links; repeated rows of a ``doc_id`` count once in a class
and get the same result; a null ``doc_id`` is an id after all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import pretokens
from lodestar.llm.common import id_key, id_value, spare_names, stored, text_key
from lodestar.llm.groups import components
from lodestar.llm.toxicity import scramble, span_hashes, word_spans

N, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 20, 6, 0.999
MARGIN = 0.2
BLOCK = 512
#: Values on which pairs agree in some tree, at least, when recall is measured.
FLOOR = 2
#: Linked pairs within so much of the threshold are the least similar ones; so many of them are enough.
NEAR, ENOUGH = 0.1, 30
BATCH = 1 << 20


# ------------------------------------------------------------------ shingles and signatures
def shingles(texts: list[str], n: int = N) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, starts, ends, doc = word_spans(texts)
    words = span_hashes(raw, starts, ends)
    counts = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    mixed = np.zeros(len(words), np.uint64)
    for k in range(min(n, len(words))):  # the run of n words from each place; runs over a text's end aren't used
        mixed[:len(words) - k] = scramble(mixed[:len(words) - k] * np.uint64(0x9E3779B97F4A7C15) + words[k:] + np.uint64(k))
    out = []
    for i in range(len(texts)):
        a, m = first[i], counts[i]
        if m >= n:
            out.append(np.unique(mixed[a:a + m - n + 1]))
        elif m:
            whole = np.uint64(m)
            for w in words[a:a + m]:
                whole = scramble(np.array([whole * np.uint64(0x9E3779B97F4A7C15) + w], np.uint64))[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, count, np.uint64)


def signature(values: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], step: int = 2048) -> np.ndarray:
    """MinHash values (upper 32 bits of a multiply-add) of a set of hashes."""
    low = np.full(len(seeds[0]), 2**32 - 1, np.uint32)
    for a in range(0, len(values), step):
        mixed = values[a:a + step, None] * seeds[0] + seeds[1]
        low = np.minimum(low, (mixed >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return low


def _sign(batches: Iterator[pa.RecordBatch], n: int, count: int) -> Iterator[pa.RecordBatch]:
    seeds = _seeds(count)
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pretokens.runs(batch["text"], BATCH):
                mine = batch.slice(part.start, part.stop - part.start)
                sets = shingles(pretokens.texts_of(mine["text"]), n)
                k1 = [int(np.bitwise_xor.reduce(scramble(s), initial=np.uint64(0)).view(np.int64)) for s in sets]
                k2 = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "d": mine["d"], "t": mine["t"], "n": pa.array([len(s) for s in sets], pa.int32()),
                    "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()),
                    "sig": pa.array([signature(s, seeds).astype("<u4").tobytes() if len(s) else None for s in sets], pa.binary())})


def shortened(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix, from full depth down, at which the forest should reach the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def measured(pairs: list[tuple[float, int]], threshold: float, depth: int, target: float) -> tuple[int, float] | None:
    """The longest prefix, from full depth down, that finds the target share of linked pairs (similarity, values agreed on).

    With that share; None without linked pairs. It judges a forest by known pairs; the join's own depth is ``shortened``.
    """
    linked = [p for p in pairs if p[0] >= threshold - 1e-9]
    near = [p for p in linked if p[0] < threshold + NEAR]
    judged = near if len(near) >= ENOUGH else linked
    if not judged:
        return None
    while True:
        recall = sum(agreed >= depth for _, agreed in judged) / len(judged)
        if recall >= target or depth <= FLOOR:
            return depth, recall
        depth -= 1


# ------------------------------------------------------------------ blocks
def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys``, one table per group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy() for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([np.r_[True, c[1:] != c[:-1]] for c in columns]))
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """A spanning forest of the links among members 0..n-1, smallest member first."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for _ in range(64):
            ra, rb = self.up[a], self.up[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            if (low == high).all():
                return
            np.minimum.at(self.up, high, low)
            while (self.up[self.up] != self.up).any():
                self.up = self.up[self.up]
        raise ValueError("links did not settle")


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members in order of id, the places of the two blocks' members (equal within one block)."""
    ids, side = table["c"].to_numpy(), table["blk"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    return ids, np.flatnonzero(side == i), np.flatnonzero(side == j)


def _same_values(table: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many values the signatures of each pair agree."""
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(table.num_rows, -1)
    same = np.zeros((len(left), len(right)), np.int16)
    for k in range(sig.shape[1]):
        same += sig[left, k][:, None] == sig[right, k][None, :]
    return same


def _agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Edges of a spanning forest of the pairs whose signatures agree in a share of ``least`` or more."""
    for table in _runs(batches, ["g", "i", "j"]):
        table = table.sort_by("c")
        ids, left, right = _sides(table)
        same = _same_values(table, left, right)
        a, b = np.nonzero(same >= least * (len(table["sig"][0].as_py()) // 4))
        a, b = left[a], right[b]
        forest = _Forest(len(ids))
        forest.link(a[a != b], b[a != b])
        far = np.flatnonzero(forest.up != np.arange(len(ids)))
        if len(far):
            yield pa.RecordBatch.from_pydict({"a": pa.array(ids[far]), "b": pa.array(ids[forest.up[far]])})


def common(a: list[np.ndarray], b: list[np.ndarray], wanted: np.ndarray, step: int = 2048) -> np.ndarray:
    """Sizes of the intersections of sets of ``a`` with sets of ``b``, of the ``wanted`` pairs at least."""
    if wanted.sum() <= max(64, wanted.size // 50):  # few: one by one
        out = np.zeros(wanted.shape, np.int64)
        for i, j in zip(*np.nonzero(wanted)):
            out[i, j] = np.intersect1d(a[i], b[j], assume_unique=True).size
        return out
    left, right = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(left, right)
    out = np.zeros((len(a), len(b)), np.float32)

    def places(values, sets):
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        hit = both[at] == values if len(both) else np.zeros(len(values), bool)
        return at[hit], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit]

    (ca, ra), (cb, rb) = places(left, a), places(right, b)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, ra, cb, rb = ca[oa], ra[oa], cb[ob], rb[ob]
    for lo in range(0, len(both), step):
        sa, sb = slice(*np.searchsorted(ca, [lo, lo + step])), slice(*np.searchsorted(cb, [lo, lo + step]))
        x, y = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
        x[ra[sa], ca[sa] - lo] = 1
        y[rb[sb], cb[sb] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """For each member of a pair of blocks: its links there, and its root in their spanning forest."""
    for table in _runs(batches, ["g", "i", "j"]):
        table = table.sort_by("c")
        ids, left, right = _sides(table)
        likely = _same_values(table, left, right) >= (threshold - MARGIN) * (len(table["sig"][0].as_py()) // 4)
        likely &= left[:, None] != right[None, :]
        rows, columns = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
        if not len(rows):
            continue
        left, right, likely = left[rows], right[columns], likely[np.ix_(rows, columns)]
        sets = {k: np.frombuffer(table["set"][int(k)].as_py(), np.uint64) for k in np.union1d(left, right)}
        met = common([sets[k] for k in left], [sets[k] for k in right], likely)
        size = np.array([len(sets[k]) if k in sets else 0 for k in range(len(ids))])
        union = size[left][:, None] + size[right][None, :] - met
        # a similarity of exactly the threshold counts, whatever the rounding of the division
        linked = (met >= threshold * union - 1e-9) & likely
        a, b = np.nonzero(linked)
        forest = _Forest(len(ids))
        forest.link(left[a], right[b])
        n = np.zeros(len(ids), np.int64)
        n[left] += linked.sum(axis=1)
        if table["i"][0].as_py() != table["j"][0].as_py():
            n[right] += linked.sum(axis=0)
        some = np.flatnonzero(n)
        if len(some):
            yield pa.RecordBatch.from_pydict({"c": pa.array(ids[some]), "links": pa.array(n[some]),
                                              "root": pa.array(ids[forest.up[some]])})


def in_blocks(members: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Copies each member (g, c, ...) to the pairs of blocks (i <= j) of its group that its block ``blk`` is in."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = members.join(sizes, "g").withColumn("m", blocks).withColumn(
        "blk", F.pmod(F.xxhash64("c", F.lit("block")), F.col("m")).cast("int"))
    others = F.sequence(F.lit(0), F.col("m") - 1)
    pairs = F.transform(others, lambda k: F.struct(F.least(k, F.col("blk")).alias("i"), F.greatest(k, F.col("blk")).alias("j")))
    spread = dealt.withColumn("p", F.explode(pairs)).select("*", "p.i", "p.j").drop("p", "m", "size")
    return spread.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")


# ------------------------------------------------------------------ operator
def similarity_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, trees: int = TREES,
                    depth: int = DEPTH, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """(d, t, n, class, links, group): for each distinct document row its class, links and group of linked classes.

    ``links`` counts the other classes of similarity ``threshold`` or more, ``n`` the row's shingles. ``d``, ``t``:
    see ``common``.
    """
    rows = docs.select(id_key().alias("d"), text_key().alias("t"), F.col("text").alias("text"))
    signed = stored(rows.mapInArrow(lambda it: _sign(it, n, trees * depth),
                                    "d long, t long, n int, k1 long, k2 long, sig binary"), "signatures")
    keyed = signed.where("n > 0").groupBy("n", "k1", "k2")
    # a class is named by its smallest id c0; as an id may have several texts, classes go by a number c of their own
    first = F.min(F.struct("d", "t")).alias("first")
    classes = stored(keyed.agg(first, F.min("sig").alias("sig"))
                          .select("n", "k1", "k2", F.col("first.d").alias("c0"), F.col("first.t").alias("ct"), "sig",
                                  F.monotonically_increasing_id().alias("c")), "classes")

    # the forest: subtries at the shortened depth, and which members they hold
    d = shortened(threshold, trees, depth, target)
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    prefix = F.xxhash64("tree", F.substring(F.col("sig"), F.col("tree") * (4 * depth) + 1, F.lit(4 * d)))
    places = classes.select("c", "sig", tree.alias("tree")).select("c", "tree", prefix.alias("g"))
    wide = lambda h: F.sum(h.cast("decimal(38,0)"))
    subtries = (places.groupBy("g", "tree")
                      .agg(F.count(F.lit(1)).alias("size"), wide(F.xxhash64("c")).alias("s1"),
                           wide(F.xxhash64("c", F.lit(1))).alias("s2"))
                      .where("size > 1"))
    once = subtries.groupBy("size", "s1", "s2").agg(F.min(F.struct("tree", "g")).alias("at")).select("at.g", "size")
    once = stored(once, "subtries")
    members = places.join(once.select("g"), "g", "left_semi").select("g", "c")
    with_sig = members.join(classes.select("c", "sig"), "c")
    agreeing = in_blocks(with_sig, once, block).mapInArrow(
        lambda it: _agreeing(it, threshold - MARGIN), "a long, b long")
    families = components(agreeing).select(F.col("node").alias("c"), F.col("root").alias("g"))
    families = stored(families, "families")

    # exact verification inside families, from the representatives' texts
    chosen = families.join(classes.select("c", F.col("c0").alias("d"), F.col("ct").alias("t"), "sig"), "c")
    texts = rows.join(chosen, ["d", "t"]).dropDuplicates(["c"]).select("g", "c", "sig", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pretokens.runs(batch["text"], BATCH):
                    mine = batch.slice(part.start, part.stop - part.start)
                    found = [s.tobytes() for s in shingles(pretokens.texts_of(mine["text"]), n)]
                    yield pa.RecordBatch.from_pydict({"g": mine["g"], "c": mine["c"], "sig": mine["sig"], "set": pa.array(found, pa.binary())})

    listed = texts.mapInArrow(sets, "g long, c long, sig binary, set binary")
    sizes = families.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    verified = stored(in_blocks(listed, sizes, block).mapInArrow(
        lambda it: _verify(it, threshold), "c long, links long, root long"), "links")
    links = verified.groupBy("c").agg(F.sum("links").alias("links"))
    linked = components(verified.select(F.col("c").alias("a"), F.col("root").alias("b")).where("a <> b"))
    named = linked.join(classes.select(F.col("c").alias("node"), "c0"), "node")
    groups = named.groupBy("root").agg(F.min("c0").alias("group"))
    of_class = (classes.select("n", "k1", "k2", "c", "c0").join(links, "c", "left")
                       .join(linked.join(groups, "root").select(F.col("node").alias("c"), "group"), "c", "left")
                       .select("n", "k1", "k2", F.col("c0").alias("class"), F.coalesce("links", F.lit(0)).alias("links"),
                               F.coalesce("group", "c0").alias("group")))
    mine = signed.select("d", "t", "n", "k1", "k2").distinct()
    out = mine.where("n > 0").join(of_class, ["n", "k1", "k2"])
    alone = mine.where("n = 0")
    return (out.select("d", "t", "n", "class", F.col("links").cast("long").alias("links"), "group")
               .unionByName(alone.select("d", "t", "n", F.col("d").alias("class"), F.lit(0).cast("long").alias("links"),
                                         F.col("d").alias("group"))))


def joined(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links, group_id), one row per distinct document."""
    return similarity_join(docs, **options).select(
        id_value("d").alias("doc_id"), id_value("class").alias("class_id"), F.col("links").alias("n_links"),
        id_value("group").alias("group_id"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of linked documents: that of the smallest ``doc_id``.

    If several rows carry that id, the one whose text hashes lowest stays, once. Texts without words all stay.
    """
    found = stored(similarity_join(docs, **options).select("d", "t", "n", "group"), "near-copies")
    first = found.where("n > 0").groupBy("group").agg(F.min(F.struct("d", "t")).alias("f"))
    keys = first.select("f.d", "f.t").unionByName(found.where("n = 0").select("d", "t"))
    d, t = spare_names(docs.columns, "d", "t")
    mine = docs.withColumns({d: id_key(), t: text_key()}).dropDuplicates([d, t])
    return mine.join(keys.toDF(d, t), [d, t], "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
