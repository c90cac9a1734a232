"""The registered queries against their SQL, or their shape where SQL has none."""

import warnings

import pytest
from compare import differences, engine

import __spark_entry__ as entry_points
from stayledger.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, key):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = llm.queries()[key](spark, SF)
        assert differences(df, engine(SF), llm.oracle_sql()[key]) == ""


@pytest.mark.parametrize("key", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_query_covers_its_table(spark, key):
    rows = llm.queries()[key](spark, SF).collect()
    name, column = ("pages", "page_id") if key.startswith("op7") else ("documents", "doc_id")
    want = {r[column] for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()}
    assert {r[column] for r in rows} == want


def test_ten_operators_and_the_pipeline_are_registered():
    names = set(entry_points.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
