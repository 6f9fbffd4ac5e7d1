"""URL filter: host rules, and a ratio of two character language models for the rest.

A rule names a host with its subdomains and a path prefix; the longest that
fits decides. The urls that rules decide train two variable-order Markov models
over characters, one of allowed and one of blocked urls. A character's
probability after its last ``ORDER`` characters interpolates all shorter
contexts (Witten-Bell: a context with ``t`` different followers in ``n``
occurrences leaves ``t / (n + t)`` to the next shorter one). A url is allowed
if its mean log-likelihood difference per character reaches a threshold, which
is calibrated on a fifth of the ruled urls that the models have not seen
(largest mean of the two classes' hit rates on a grid of ``GRID``).

Only built-in functions run. Counts and scores are taken on distinct urls and
on distinct strings of ``ORDER + 1`` characters; the table of those strings is
broadcast only after its rows are counted.

Defined results: a url that is null or has no ``://`` has an empty host and
path; characters outside printable ASCII count as one sign; a url without
characters has difference 0; without ruled urls of both kinds, or without held
out ones, the threshold is 0 and missing models score 0; repeated rows get the
same verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.hashing import portable_bucket
from lodestar.llm.common import ascii_lower, spare_names, stored, without

# The rules, (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 4
GRID = 0.01
#: Distinct characters a model can meet: printable ASCII and the sign for all others.
ALPHABET = 95
#: Stands before the first character.
EDGE = "\t"
HELD_OUT, FOLDS, SEED = 0, 5, 7
BROADCAST_ROWS = 1_000_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    text = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.substring(text, F.instr(text, "://") + 3, F.length(text))).otherwise("")
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + prefix))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def model_text(url: Column) -> Column:
    """What the models read: the url in lower case, every character outside printable ASCII as ``~``."""
    return F.regexp_replace(ascii_lower(F.coalesce(url, F.lit(""))), r"[^\x21-\x7e]", "~")


def grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """Adds one row per character: ``gram``, the character after its last ``order`` ones."""
    padded = F.concat(F.lit(EDGE * order), F.col("s"))
    at = F.when(F.length("s") > 0, F.sequence(F.lit(1), F.length("s"))).otherwise(F.array().cast("array<int>"))
    return urls.withColumn("gram", F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(order + 1)))))


def gram_scores(train: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, diff): log-likelihood of each wanted gram's last character, allowed minus blocked."""
    counts = stored(grams(train, order).groupBy("gram").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")),
        "url-grams")
    kinds = ("a", "b")
    out = wanted.withColumns({f"p_{k}": F.lit(1.0 / ALPHABET) for k in kinds})
    for length in range(order + 1):  # length of the context
        tail = F.substring("gram", order + 1 - length, length + 1)
        seen = counts.groupBy(tail.alias("tail")).agg(*(F.sum(k).alias(k) for k in kinds))
        context = F.substring("tail", 1, length)
        sums = seen.groupBy(context.alias("context")).agg(
            *(F.sum(k).alias(f"n_{k}") for k in kinds), *(F.count_if(F.col(k) > 0).alias(f"t_{k}") for k in kinds))
        out = (out.withColumns({"tail": tail, "context": F.substring("gram", order + 1 - length, length)})
                  .join(seen, "tail", "left").join(sums, "context", "left"))
        for k in kinds:
            n, t = F.coalesce(f"n_{k}", F.lit(0)), F.coalesce(f"t_{k}", F.lit(0))
            p = F.col(f"p_{k}")
            out = out.withColumn(f"p_{k}", F.when(n + t > 0, (F.coalesce(F.col(k), F.lit(0)) + t * p) / (n + t)).otherwise(p))
        out = out.select("gram", *(f"p_{k}" for k in kinds))
    return out.select("gram", (F.log("p_a") - F.log("p_b")).alias("diff"))


def url_scores(urls: DataFrame, scores: DataFrame, order: int = ORDER) -> DataFrame:
    """``urls`` (key s) with ``score``: the mean difference per character, 0 without characters."""
    table = F.broadcast(scores) if scores.count() <= BROADCAST_ROWS else scores
    sums = (grams(urls.select("s").distinct(), order).join(table, "gram")
            .groupBy("s").agg(F.sum("diff").alias("total")))
    return urls.join(sums, "s", "left").withColumn(
        "score", F.coalesce(F.col("total") / F.length("s"), F.lit(0.0))).drop("total")


def calibrate(scored: DataFrame) -> float:
    """Threshold with the largest mean of the classes' hit rates; among equals the one nearest 0."""
    step = F.floor(F.col("score") / GRID).cast("long")
    bins = (scored.groupBy(step.alias("bin")).agg(F.count_if(F.col("verdict") == "allow").alias("a"),
                                                  F.count_if(F.col("verdict") == "block").alias("b")))
    # Scores lie between the logs of the smallest probabilities, so the grid has a few thousand cells at most.
    rows = sorted((r["bin"], r["a"], r["b"]) for r in bins.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0.0
    best, a_below, b_below = (-1.0, 0.0, 0.0), 0, 0
    for bin_, a, b in [*rows, (rows[-1][0] + 1, 0, 0)]:
        rate = ((allowed - a_below) / allowed + b_below / blocked) / 2
        best = max(best, (round(rate, 12), -abs(bin_ * GRID), bin_ * GRID))
        a_below, b_below = a_below + a, b_below + b
    return best[2]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """``pages`` with host, path, rule, verdict, score (null where a rule decided)."""
    results = ("host", "path", "rule", "verdict", "score")
    h, p, s, r, ruled, said, value = spare_names(pages.columns + list(results), "h", "p", "s", "r", "ruled", "said", "value")
    host, path = url_parts(F.col("url"))
    split = pages.withColumns({h: host, p: path, s: model_text(F.col("url"))})
    rule, verdict = fitting_rule(F.col(h), F.col(p), rules)
    split = split.withColumns({r: rule, ruled: verdict})
    urls = stored(split.select(F.col(s).alias("s"), F.col(ruled).alias("verdict")).distinct(), "urls")
    fold = portable_bucket("s", SEED, FOLDS)
    known = urls.where(F.col("verdict").isNotNull())
    train, held = known.where(fold != HELD_OUT), known.where(fold == HELD_OUT)
    rest = urls.where(F.col("verdict").isNull())
    wanted = grams(rest.unionByName(held), order).select("gram").distinct()
    scores = stored(gram_scores(train, wanted, order), "gram-scores")
    threshold = calibrate(url_scores(held, scores, order))
    judged = url_scores(rest, scores, order).select(
        F.col("s").alias(s), F.col("score").alias(value),
        F.when(F.col("score") >= threshold, "allow").otherwise("block").alias(said))
    out = split.join(judged, s, "left")
    return out.select(*(F.col(f"`{c}`") for c in without(pages.columns, results)), F.col(h).alias("host"), F.col(p).alias("path"),
                      F.col(r).alias("rule"), F.coalesce(ruled, said).alias("verdict"),
                      F.when(F.col(r).isNull(), F.col(value)).alias("score"))
