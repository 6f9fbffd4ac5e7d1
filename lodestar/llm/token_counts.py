"""Token counts under a unigram model, by dynamic programming along a trie.

Each token of a public vocabulary has a log probability that depends on its
rank only (Zipf-Mandelbrot, ``-ln(rank + SHIFT)``; nothing is trained). A
pre-token is cut into the tokens of the highest total; ties go to fewer tokens,
then to the longer last token. The distinct pre-tokens of a batch are visited
in sorted order, which is the depth-first order of their trie: forward scores
are kept for the bytes of the current path, so those of a shared prefix are
computed once, and the count at a pre-token's end is stored as its terminal
count. Texts sum the counts of their pre-tokens. Nothing is shuffled; a worker
holds the distinct pre-tokens of one batch.

Defined results: a null or empty text has no pre-tokens and no tokens; repeated
rows count alike; columns named in ``keep`` pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm import pretokens
from lodestar.llm.bpe import read_ranks
from lodestar.llm.common import without

SHIFT = 2.7
#: Bytes of text whose distinct pre-tokens make one trie.
BATCH = 8_000_000


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probability of every token, up to a constant that all tokens share."""
    return {t: -math.log(r + SHIFT) for t, r in ranks.items()}


def terminal_counts(words: Sequence[bytes], scores: dict[bytes, float], longest: int) -> list[int]:
    """Token count of each of the sorted words; every single byte must be a token."""
    best, count, path, out = [0.0], [0], b"", []
    get = scores.get
    for word in words:
        n, same = len(word), 0
        stop = min(n, len(path))
        while same < stop and word[same] == path[same]:
            same += 1
        del best[same + 1:], count[same + 1:]
        for end in range(same + 1, n + 1):
            top, fewest = -math.inf, 0
            for begin in range(max(0, end - longest), end):  # the longest last token first
                s = get(word[begin:end])
                if s is not None:
                    s += best[begin]
                    c = count[begin] + 1
                    if s > top or s == top and c < fewest:
                        top, fewest = s, c
            best.append(top)
            count.append(fewest)
        path = word
        out.append(count[n])
    return out


def _count(batches: Iterator[pa.RecordBatch], keep: Sequence[str], scores: dict[bytes, float]) -> Iterator[pa.RecordBatch]:
    longest = max(map(len, scores))
    for batch in batches:
        for part in pretokens.runs(batch["text"], BATCH):
            mine = batch.slice(part.start, part.stop - part.start)
            words, codes, docs = pretokens.split(pretokens.texts_of(mine["text"]))
            listed = words.to_pylist()
            order = sorted(range(len(listed)), key=listed.__getitem__)
            counts = np.zeros(len(listed), np.int64)
            counts[order] = terminal_counts([listed[i] for i in order], scores, longest)
            sums = np.concatenate([[0], np.cumsum(counts[codes])])[docs]
            out = {c: mine[c] for c in keep}
            out["n_pretokens"], out["n_tokens"] = pa.array(np.diff(docs)), pa.array(np.diff(sums))
            yield pa.RecordBatch.from_pydict(out)


def count_tokens(docs: DataFrame, ranks_path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with n_pretokens and n_tokens (long), which replace kept ones of these names."""
    scores, names = zipf_scores(read_ranks(ranks_path)), without(keep, ("n_pretokens", "n_tokens"))
    kept = [f"k{i}" for i in range(len(names))]
    schema = T.StructType([*(T.StructField(k, docs.schema[c].dataType) for k, c in zip(kept, names)),
                           T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    rows = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)), F.col("text").alias("text"))
    return rows.mapInArrow(lambda it: _count(it, kept, scores), schema).toDF(*names, "n_pretokens", "n_tokens")
