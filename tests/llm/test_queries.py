"""The registered queries against their SQL, and the pipeline against its stages' plain versions."""

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__
import corpus_pipeline
from lodestar.llm import queries
from lodestar.llm.common import stored
from lodestar.plans.catalog import load, table_path


def test_all_queries_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_says_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_pipeline_stages(spark):
    from test_documents import plain_contamination, plain_join, plain_lines
    docs = load(spark, SF_SMALL, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in load(spark, SF_SMALL, "benchmark").collect()]
    plain = None
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "byte_bpe":
            assert docs.columns == columns
        rows = docs.collect()
        if name == "toxicity":  # held out accuracy is tested with the operator
            plain = [(r.doc_id, r.text) for r in rows]
            assert 0.8 * 200 <= len(plain) <= 200
        elif name == "line_dedup":
            plain = [(i, t) for i, _, _, t in plain_lines(plain)]
            assert sorted((r.doc_id, r.text) for r in rows) == sorted(plain)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "ngram_join":
            stay = {g for _, _, _, g in plain_join(plain)}
            plain = [(i, t) for i, t in plain if i in stay]
            assert sorted((r.doc_id, r.text) for r in rows) == sorted(plain)
        elif name == "decontamination":
            bad = {x[0] for x in plain_contamination(plain, items) if x[-1]}
            plain = [(i, t) for i, t in plain if str(i) not in bad]
            assert sorted((r.doc_id, r.text) for r in rows) == sorted(plain)
        else:
            assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in plain)
