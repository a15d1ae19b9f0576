"""Every query of the subpackage: against its SQL, and on awkward and empty tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tapeloom.llm.queries import ORACLE, QUERIES
from tests.compare import assert_equal

ALL = {**QUERIES, "pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, testdata, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        db.execute(f"create view {table} as select * from '{testdata}/sf0.01/{table}.parquet'")
    assert assert_equal(QUERIES[name](spark, str(testdata / "sf0.01")), db, ORACLE[name]) > 0


@pytest.mark.parametrize("name", list(ALL))
def test_awkward_and_empty_tables(spark, folders, name):
    assert ALL[name](spark, folders["nothing"]).count() == 0
    rows = ALL[name](spark, folders["awkward"]).count()
    documents = spark.read.parquet(f"{folders['awkward']}/documents.parquet").count()
    if name == "op4_url_filters":
        assert rows == 6
    elif name == "op11_filter_audit":
        assert rows == 120 * 5 * 4  # four sources
    elif name == "quality_rule_ablation":
        assert rows == 2 + 6 + 4  # rules of three policies
    elif name == "op12_whitening":
        assert rows == 5 * 3  # usable vectors, and their length
    elif name not in ("op7_mixing", "pipeline"):
        assert rows == documents


@pytest.mark.parametrize("name", ["op8_quality_rules", "op10_license_scan"])
def test_native_plans(spark, folders, name, capsys):
    QUERIES[name](spark, folders["awkward"]).explain()
    plan = capsys.readouterr().out
    assert not [step for step in ("Python", "Pandas", "Arrow", "Exchange") if step in plan]
