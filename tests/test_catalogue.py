"""Every registered query of the entity engine against its SQL form."""

import os

import duckdb
import pytest

from loamline.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in (r[k] for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert shown(got.columns, map(tuple, got.collect())) == shown(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_detected_languages_are_right(spark):
    got = catalogue.language_detect(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    assert sum(r.language == r.lang for r in got) >= 0.97 * len(got)
