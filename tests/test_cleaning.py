"""Cleaning many columns: compiled code, and the same results as one by one."""

import re

from pyspark.sql import functions as F

from stayledger import constants as C
from stayledger.functions import dates, text
from stayledger.operators import columns as ops
from stayledger.operators import geo
from stayledger.plans.silver import clean_stateless, cleaned_places
from stayledger.session import COMPILED_METHOD_BYTES
from stayledger.streaming import places


def test_cleaning_code_stays_small_enough_to_be_compiled(spark, tmp_path, capsys):
    """The JVM interprets generated methods above 8000 bytes."""
    text_columns = [*C.EDGE_CLEANED_COLUMNS, *C.RATING_COLUMNS, *C.MONEY_COLUMNS, "total_rooms"]
    spark.createDataFrame([tuple("x" for _ in text_columns)], text_columns).write.parquet(f"{tmp_path}/raw")
    cleaned = clean_stateless(spark.read.parquet(f"{tmp_path}/raw"))
    capsys.readouterr()
    cleaned.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < COMPILED_METHOD_BYTES


def test_columns_cleaned_together_are_cleaned_like_each_alone(spark):
    rows = [("?a!", None, "2001-02-03"), (None, " _b_\n", "31/12/1999"), ("..", "c-d", "12/31/1999"), ("", "x#\r", "no")]
    df = spark.createDataFrame(rows, "a string, b string, day string")
    together = ops.parse_dates(ops.strip_edges(df, ["a", "b", "missing"]), ["day"])
    alone = df.withColumns({c: text.strip_edges(F.col(c)) for c in "ab"}).withColumn("day", dates.parse_date(F.col("day")))
    assert together.columns == ["a", "b", "day"]
    assert together.collect() == alone.collect()


def test_places_are_cleaned_once_a_text_and_only_with_a_key(spark):
    rows = [("h1", "!X", "C", None), ("h1", "X", "C", None), ("--", "Y", "D", "E"), (None, "Z", None, None), ("h2", None, " ", "E")]
    raw = spark.createDataFrame(rows, "hotel_id string, hotel_name string, city string, country string")
    seen = geo.place_keys(cleaned_places(raw)).collect()
    assert set(map(tuple, seen)) == {("Unknown", "", "E"), ("X", "C", None)} and len(seen) == 2


def test_a_batch_without_new_places_adds_no_folder_of_places(spark, tmp_path):
    rows = spark.createDataFrame([("H", "C", "E"), (None, "C", None)], "hotel_name string, city string, country string")
    places.start_places(rows.limit(1), str(tmp_path))
    for number, batch in enumerate([rows.limit(1), rows, rows]):
        places.add_batch(batch, str(tmp_path), number)
    assert sorted(p.name for p in (tmp_path / "places").glob("batch_id=*")) == ["batch_id=-1", "batch_id=1"]
    assert set(map(tuple, places.seen_places(spark, str(tmp_path)).collect())) == set(map(tuple, rows.collect()))
