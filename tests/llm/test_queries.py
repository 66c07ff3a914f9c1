"""The registered corpus queries against their SQL forms, and the pipeline against its parts."""

import duckdb
import pytest
from llm_rows import rows_of
from test_operators import alnum, brute_hits

import corpus_pipeline
from loamline.llm import mixing, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF).select(columns)
    shown = lambda rows: sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)
    assert shown(got.collect()) == shown(want.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    toxic = {x.doc_id for x in toxicity.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if x.predicted}
    items = [tuple(x) for x in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {x.doc_id: x.text for x in docs.collect()}
    assert not toxic & {x.doc_id for x in got}
    assert not any(h[5] for h in brute_hits([(x.doc_id, x.text) for x in got], items))
    dirty = {h[0] for h in brute_hits(texts.items(), items) if h[5]}
    assert all(x.text == texts[x.doc_id] and x.n_chars == len(x.text) for x in got if x.doc_id not in dirty)
    assert all(len(alnum(x.text)) < len(alnum(texts[x.doc_id])) for x in got if x.doc_id in dirty)
    slots = {}
    for x in got:
        slots.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mixing_lays_rows_out_by_shard_and_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.copies(docs)
    want = [x.doc_id for x in sorted(mixed.collect(), key=lambda x: (x.shard, x.order))]
    parts = corpus_pipeline.mix_sources(spark, docs, SF).rdd.glom().collect()
    assert [x.doc_id for part in parts for x in part] == want and len({x.shard for x in mixed.collect()}) == 8


def test_stages_return_the_columns_of_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns
        assert rows_of(docs.select("doc_id")) is not None
