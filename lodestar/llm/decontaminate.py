"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of ASCII letters and digits and of any non-ASCII characters,
with A-Z lower-cased. One pass over the documents posts the terms that the
benchmark may need: for every phrase (13 consecutive words of an item, or the
whole of a shorter item) its ``CANDIDATES`` rarest words within the benchmark,
and a closing mark whose position is the document's length. The stored postings
tell how frequent these words are in the documents; a phrase is then searched
from its ``ANCHORS`` rarest words by intersecting their lists, each moved back
by the word's offset in the phrase. The places where the lists meet are
compared with the document's words, so what is returned is exact.

Only built-in functions run. Lists of a frequent word are never gathered: the
postings stay rows and meet the phrases in a broadcast join (the phrases' number
is checked; beyond ``BROADCAST_ROWS`` Spark plans an ordinary join), and the
intersection is an aggregation by document, phrase and place.

Defined results: null and empty texts have no words; null items have no
phrases; an item whose ``item_id`` is null marks words as hit but is in no list
of items; repeated document rows get a result each; a null ``doc_id`` is an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import ascii_lower, id_key, id_value, stored, text_key, text_of

#: Everything in ASCII that is neither a letter nor a digit; one by one, which the matcher tests fastest.
SEPARATORS = "[" + "".join(f"\\x{i:02x}" for i in range(128) if not chr(i).isalnum()) + "]+"
#: The closing mark: no word has a blank.
END = " "
CANDIDATES, ANCHORS = 4, 2
BROADCAST_ROWS = 200_000


def split_words(text: Column) -> Column:
    """The words of a text, in its own case."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def small(df: DataFrame) -> DataFrame:
    """Broadcast if counted to be below ``BROADCAST_ROWS`` rows; otherwise left to the planner."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def phrases(items: DataFrame, length: int) -> DataFrame:
    """(phrase, len, items): the distinct phrases with the item ids that hold them, as strings."""
    words = items.select(F.col("item_id").cast("string").alias("item"),
                         split_words(ascii_lower(text_of())).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    parts = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, length))).alias("part"))
    return (parts.groupBy(F.array_join("part", END).alias("phrase"))
                 .agg(F.first(F.size("part")).alias("len"), F.collect_set("item").alias("items")))


def candidate_terms(wanted: DataFrame) -> DataFrame:
    """(pid, len, off, term): the rarest words of each phrase, counted within the benchmark."""
    terms = wanted.select(F.xxhash64("phrase").alias("pid"), "len",
                          F.posexplode(F.split("phrase", END)).alias("off", "term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("pid").orderBy("n", "term", "off")
    return (terms.join(counts, "term").withColumn("r", F.row_number().over(rarest))
                 .where(F.col("r") <= CANDIDATES).select("pid", "len", "off", "term"))


def post(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, d, t, pos): the postings of the vocabulary's terms and of the closing mark."""
    tokens = docs.select(id_key().alias("d"), text_key().alias("t"),
                         F.posexplode(F.concat(split_words(text_of()), F.array(F.lit(END)))).alias("pos", "word"))
    # Unicode's lower case is the cheaper join key; A-Z alone decides.
    lookup = vocabulary.select("term", F.lower("term").alias("low"))
    met = tokens.join(small(lookup), F.lower("word") == F.col("low"))
    return met.where(ascii_lower(F.col("word")) == F.col("term")).select("term", "d", "t", "pos")


def anchors(candidates: DataFrame, postings: DataFrame) -> DataFrame:
    """(pid, len, off, term, n): the rarest candidates by their postings; none of a phrase with an unposted word."""
    lists = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    by_phrase = Window.partitionBy("pid")
    ranked = (candidates.join(lists, "term", "left")
              .withColumns({"all": F.count(F.lit(1)).over(by_phrase), "posted": F.count("df").over(by_phrase),
                            "r": F.row_number().over(by_phrase.orderBy("df", "term", "off"))}))
    return (ranked.where((F.col("all") == F.col("posted")) & (F.col("r") <= ANCHORS))
                  .select("pid", "len", "off", "term", F.least("all", F.lit(ANCHORS)).alias("n")))


def meeting_places(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """(d, t, start, len): where the moved lists of all anchors of a phrase meet."""
    moved = (postings.join(small(chosen), "term")
                     .select("d", "t", "pid", "len", "n", (F.col("pos") - F.col("off")).alias("start")))
    met = (moved.where(F.col("start") >= 0).groupBy("d", "t", "pid", "len", "n", "start")
                .agg(F.count(F.lit(1)).alias("met")))
    # a row that is repeated posts its words again
    return met.where(F.col("met") >= F.col("n")).select("d", "t", "start", "len").distinct()


def near_places(postings: DataFrame, chosen: DataFrame, slack: int) -> DataFrame:
    """(d, t, pid, start, gap): proximity matches, where a phrase's two anchors are off by up to ``slack`` words."""
    moved = (postings.join(small(chosen), "term")
                     .select("d", "t", "pid", "off", (F.col("pos") - F.col("off")).alias("start")))
    first = chosen.groupBy("pid").agg(F.min("off").alias("off"))
    head = moved.join(first, ["pid", "off"]).withColumn("bin", F.floor(F.col("start") / (slack + 1)))
    tail = (moved.join(first, ["pid", "off"], "left_anti")
                 .select("d", "t", "pid", F.col("start").alias("other"))
                 .withColumn("bin", F.explode(F.sequence(F.floor((F.col("other") - slack) / (slack + 1)),
                                                         F.floor((F.col("other") + slack) / (slack + 1))))))
    gap = F.col("other") - F.col("start")
    return (head.join(tail, ["d", "t", "pid", "bin"]).where(F.abs(gap) <= slack)
                .select("d", "t", "pid", "start", gap.alias("gap")).distinct())


def occurrences(docs: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """(d, t, start, len, items): the places at which the document's words are a phrase's."""
    per_doc = stored(places.groupBy("d", "t").agg(F.collect_set(F.struct("start", "len")).alias("at")), "places")
    mine = docs.select(id_key().alias("d"), text_key().alias("t"), text_of().alias("text"))
    # only texts with places travel to them
    texts = mine.join(small(per_doc.select("d", "t")), ["d", "t"], "left_semi")
    words = texts.dropDuplicates(["d", "t"]).withColumn("w", split_words(ascii_lower(F.col("text"))))
    found = words.join(per_doc, ["d", "t"]).select("d", "t", F.explode(F.transform("at", lambda p: F.struct(
        p["start"].alias("start"), p["len"].alias("len"),
        F.array_join(F.slice("w", p["start"] + 1, p["len"]), END).alias("phrase")))).alias("p"))
    return (found.select("d", "t", "p.*").join(small(wanted.select("phrase", "items")), "phrase")
                 .select("d", "t", "start", "len", "items"))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted (start, len) spans."""
    def step(acc, s):
        end = s["start"] + s["len"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
                        F.greatest(acc["end"], end).alias("end"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, length: int = 13, share: int = 20) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    A document is contaminated if a word is hit and ``share * n_hit >= n_words``. ``d`` and ``t`` (see
    ``common``) tell the rows apart.
    """
    wanted = stored(phrases(items, length), "phrases")
    candidates = stored(candidate_terms(wanted), "candidate-terms")
    vocabulary = candidates.select("term").union(candidates.sparkSession.createDataFrame([(END,)], "term string"))
    index = stored(post(docs, vocabulary.distinct()), "postings")
    postings = index.where(F.col("term") != END)
    found = occurrences(docs, meeting_places(postings, anchors(candidates, postings)), wanted)
    hits = (found.groupBy("d", "t")
                 .agg(covered(F.array_sort(F.collect_set(F.struct("start", "len")))).cast("long").alias("n_hit"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    lengths = index.where(F.col("term") == END).select("d", "t", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    named = F.coalesce("items", F.array().cast("array<string>"))
    return (lengths.join(hits, ["d", "t"], "left")
                   .select(id_value("d").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                           F.size(named).cast("long").alias("n_items"), named.alias("items"),
                           ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), "d", "t"))
