"""Named queries of the corpus operators and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (ann, bpe, conversation_trie, decontaminate, hard_negatives, line_dedup, ngram_join, quality,
                          suffix_dedup, token_counts, token_file, toxicity, url_filter)
from lodestar.llm.common import stored
from lodestar.plans.catalog import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(load(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_LINE_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), " \
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DEDUP_LINES = f"""
  lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM docs_in)),
  keyed AS (SELECT doc_id, i, line, {_LINE_KEY} AS key FROM lines),
  firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
             GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
  marked AS (SELECT k.*, first IS NOT NULL AND first <> doc_id AS gone FROM keyed k LEFT JOIN firsts USING (key)),
  deduped AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
                     coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
              FROM marked GROUP BY doc_id)"""

ORACLE["op8_line_dedup"] = f"""
WITH docs_in AS (SELECT doc_id, text FROM documents), {_DEDUP_LINES}
SELECT doc_id, n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(text) AS kept_sha256 FROM deduped"""


def bpe_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", ["doc_id", "text"])
    return bpe_digests(bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")))


@register
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@register
def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", ["doc_id", "text"])
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer_json = f.read()
    path = token_file.new_path(spark)
    token_file.write_token_file(docs, tokenizer_json, path, end_id=2)
    return token_file.read_token_file(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(load(spark, sf_dir, "documents", ["doc_id", "text"]),
                                      load(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def _words(text: str) -> str:
    """DuckDB list of the words of a text."""
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Of the relation docs_in (doc_id, text): n_words, n_hit, the item ids and the rule.
_CONTAMINATION = f"""
  item_words AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
  windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS phrase, least(len(w), 13) AS n
              FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
                    FROM item_words WHERE len(w) > 0)),
  doc_words AS (SELECT doc_id, {_words('text')} AS w FROM docs_in),
  sizes AS (SELECT DISTINCT n FROM windows),
  grams AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
            FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS i
                  FROM doc_words, sizes)),
  found AS (SELECT g.doc_id, g.i, g.n, t.item_id FROM grams g JOIN windows t USING (phrase, n)),
  hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM found))
                GROUP BY doc_id),
  hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
  judged AS (SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
                    coalesce(items, '') AS items,
                    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
             FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id))"""

ORACLE["op1_decontaminate"] = f"""
WITH docs_in AS (SELECT doc_id, text FROM documents), {_CONTAMINATION}
SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, contaminated FROM judged"""


@register
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(load(spark, sf_dir, "pages", ["page_id", "url"]))
    return out.select("page_id", "host", "path", "rule", "verdict")


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    """Low quality first, then toxic."""
    return toxicity.fit_chain(docs, labels, {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1})


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", ["doc_id", "text"])
    chain = toxicity_chain(docs, load(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    return toxicity.score_documents(docs, chain).withColumnRenamed("flagged", "toxic")


@register
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(load(spark, sf_dir, "documents", ["doc_id", "text"]))


@register
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable(load(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding")
    found = ann.search(vectors, vectors.where(F.col("id") % 50 == 0), k=5)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


@register
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_strings(load(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _crc(col: str) -> Column:
    """Unsigned crc32 of a number's decimal text; a null's text is empty."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


@register
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", ["doc_id", "text"])
    held_out = _crc("doc_id") % 5 == 0
    model = quality.fit_quality(docs, load(spark, sf_dir, "labels", ["doc_id", "quality"]), learn=~held_out)
    return quality.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"),
                       hard_negatives.whole_numbers(F.col("embedding")).alias("v"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH vecs AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
  scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
             FROM vecs a JOIN vecs b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
  positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversation_trie.turn_sequences(load(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    own = stored(own, "trie-turns")
    base = own.where(F.col("conv") % 20 == 0).select(F.col("conv").alias("base"), F.slice("ids", 1, 3).alias("head"))
    h = (_crc("conv") % 4).cast("int")
    none = F.array().cast("array<binary>")
    rebuilt = own.join(base, F.col("conv") - F.col("conv") % 20 == F.col("base"), "left").select(
        "conv", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("ids", h + 1, F.size("ids"))).alias("ids"))
    return conversation_trie.prefix_trie(rebuilt)


#: crc32 % 4 of the bytes of a text of digits, bit by bit.
_CRC4 = """list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1),
             lambda i: CAST(ascii(CAST({0} AS VARCHAR)[i]) AS BIGINT))),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                      lambda c, b: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

ORACLE["op13_prefix_trie"] = rf"""
WITH turns AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                      len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS w
               FROM conversations WHERE conv_id IS NOT NULL),
  own AS (SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS s,
                 xor({_CRC4.format('conv_id')}, 4294967295) % 4 AS h
          FROM turns GROUP BY conv_id),
  rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.s, []) [1:o.h], o.s[o.h + 1:]) AS s
              FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
  prefixes AS (SELECT conv_id, d, len(s) = d AS ends, array_to_string(list_transform(s[1:d], lambda x: x.k), '') AS p,
                      CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w
               FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
  nodes AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
            FROM prefixes GROUP BY d, p),
  kids AS (SELECT d - 1 AS d, left(p, 64 * (d - 1)) AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1, 2),
  sums AS (SELECT a AS d, left(p, 64 * a) AS p, count(*) FILTER (kids IS NULL) AS leaves, sum((n - 1) * w) AS saved
           FROM (SELECT nodes.*, kids, unnest(range(0, nodes.d + 1)) AS a FROM nodes LEFT JOIN kids USING (d, p)) GROUP BY 1, 2)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(kids, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM nodes x JOIN sums USING (d, p) LEFT JOIN kids USING (d, p)
LEFT JOIN nodes up ON up.d = x.d - 1 AND up.p = left(x.p, 64 * (x.d - 1))"""
