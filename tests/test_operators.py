"""Frame operators on small fixtures: fills, joins, backfill, quality, measures, streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayledger.operators import aggregates, geo, joins, quality, sets
from stayledger.plans import backfill, enrich, star
from stayledger.plans import measures as m
from stayledger.sources import files, payloads, tables
from stayledger.sources.reports import report_values, write_report
from stayledger.schemas import text_schema
from stayledger.streaming import landing
from stayledger.streaming.replay import replay


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def places(spark, n=400, seed=5):
    """Bookings of which half share one hotel name and many lack a place."""
    rnd = random.Random(seed)
    data = [
        (i, "Unknown" if rnd.random() < 0.5 else f"H{rnd.randrange(20)}",
         rnd.choice([None, "", "A", "B", "C", "UNKNOWN"]), rnd.choice([None, "", "X", "Y", "UNKNOWN", "x"]))
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "id int, hotel_name string, city string, country string")


def brute_fill(data, group, target):
    """Group value by definition: smallest non-blank text, else blank, else nothing."""
    best = {}
    for row in data:
        value = row[target]
        if value is not None:
            best.setdefault(row[group], []).append(value)
    pick = {g: min((v for v in vs if v != ""), default="") for g, vs in best.items()}
    return [pick.get(row[group]) if row[target] is None else row[target] for row in data]


def test_group_fill_equals_brute_force(spark):
    data, df = places(spark)
    filled = geo.fill_within_group(df, ["city", "country"], "hotel_name")
    want = sorted(zip([d[0] for d in data], brute_fill(data, 1, 2), brute_fill(data, 1, 3)))
    got = sorted(tuple(r) for r in filled.select("id", "city", "country").collect())
    assert got == want


def test_group_fill_options(spark):
    df = spark.createDataFrame([("Unknown", None), ("Unknown", "A"), ("H", ""), ("H", "B")], "h string, c string")
    kept = geo.fill_within_group(df, ["c"], "h", exclude=["Unknown"], blank_as_null=True)
    assert rows(kept.select("h", "c")) == rows(
        spark.createDataFrame([("Unknown", None), ("Unknown", "A"), ("H", "B"), ("H", "B")], "h string, c string")
    )


def geo_by_steps(df, cities, capitals):
    """The fill steps one after the other on all rows, as a check of the place map."""
    df = geo.fill_within_group(df, ["city", "country"], "hotel_name")
    df = geo.fill_within_group(df, ["country"], "city")
    df = geo.fill_from_lookup(df, "country", "city", cities, "city", "country")
    df = geo.fill_from_lookup(df, "city", "country", capitals, "country", "capital")
    from stayledger.operators.columns import finalize_geo

    return finalize_geo(df, ["city", "country"])


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_place_map_equals_step_by_step(spark, partitions):
    _, df = places(spark)
    cities = spark.createDataFrame([("A", "X"), ("B", "Y"), ("B", "Z")], "city string, country string")
    capitals = spark.createDataFrame([("X", "CAP X"), ("Y", "CAP Y")], "country string, capital string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        fast = geo.fill_places(df, cities, capitals).select("id", "city", "country")
        assert rows(fast) == rows(geo_by_steps(df, cities, capitals).select("id", "city", "country"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_join_gives_the_same_when_too_big_to_broadcast(spark, null_safe):
    data = [(i, "hot" if i % 3 == 0 else (None if i % 5 == 0 else f"k{i % 7}")) for i in range(300)]
    df = spark.createDataFrame(data + data[:50], "id int, k string")
    lookup = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k2", 3), (None, 4), ("k2", 5)], "lk string, v int"
    )
    small = joins.lookup_join(df, lookup, [("k", "lk")], null_safe)
    big = joins.lookup_join(df, lookup, [("k", "lk")], null_safe, shuffle=True)
    assert small.columns == big.columns == ["id", "k", "v"]
    assert rows(small) == rows(big)
    assert "Broadcast" in small._jdf.queryExecution().toString()


def test_lookup_fill_only_exact_and_without_fan_out(spark):
    df = spark.createDataFrame([("a", None), ("A", None), ("A", "UNKNOWN"), ("A", ""), ("Z", "UNKNOWN")], "city string, country string")
    lookup = spark.createDataFrame([("A", "X"), ("A", "W")], "city string, country string")
    exact = geo.fill_from_lookup(df, "country", "city", lookup, "city", "country")
    assert rows(exact) == rows(spark.createDataFrame(
        [("a", None), ("A", "W"), ("A", "W"), ("A", ""), ("Z", None)], "city string, country string"))
    loose = geo.fill_from_lookup(df, "country", "city", lookup, "city", "country", match="normalized")
    assert loose.filter("city = 'a'").first()["country"] == "W"


def test_union_keeps_text_beside_numbers(spark):
    a = spark.createDataFrame([(1, "x", True)], "n int, t string, only_a boolean")
    b = spark.createDataFrame([("y", "abc")], "t string, n string")
    assert rows(sets.union_sources(a, b)) == [("1", "x"), ("abc", "y")]


def test_split_is_complete_and_deterministic(spark):
    df = spark.range(10_000).withColumn("key", F.when(F.col("id") % 100 > 0, F.col("id").cast("string")))
    batch, stream = sets.split_batch_stream(df, "key")
    assert batch.count() + stream.count() == 10_000
    assert 0.66 < batch.count() / 10_000 < 0.74
    assert batch.join(stream, "id").count() == 0


def test_backfill_and_flat_rates_add_nothing_twice(spark):
    want = spark.createDataFrame([("A",), ("B",), ("C",)], "city string")
    have = spark.createDataFrame([("A", 1)], "city_name string, v int")
    new = spark.createDataFrame([("A", 9), ("B", 2), ("B", 3), ("D", 4)], "city_name string, v int")
    first = backfill.backfill(want, have, new, {"city": "city_name"})
    assert rows(first) == [("B", 2), ("B", 3)]
    assert backfill.backfill(want, have.unionByName(first), new, {"city": "city_name"}).count() == 0
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), "EUR", 0.9)], "rate_date date, currency_code string, usd_rate double")
    once = backfill.append_fallback_rates(rates)
    assert once.count() == 14
    assert rows(backfill.append_fallback_rates(once)) == rows(once)


def test_weather_defaults_differ_from_missing_numbers(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), None), ("B", dt.date(2024, 1, 1), 10.0)], "city string, checkin_date date, total_price_usd double")
    weather = spark.createDataFrame([("2024-01-01", "A", 0.0, 0.6)], "weather_date string, city_name string, temp_max double, rain_sum double")
    got = rows(enrich.enrich_weather(df, weather).select("city", "temp_max", "rain_sum", "is_rainy", "price_category"))
    assert got == [("A", 0.0, 0.6, True, "Luxury"), ("B", 22.5, 0.0, False, "Budget")]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 1, 2), 2), ("a", None, 3), ("b", None, 4)],
        "k string, d date, v int",
    )
    assert rows(star.latest_per_key(df, "k", "d")) == rows(df.filter("v in (2, 4)"))


def test_suite_counts(spark):
    df = spark.createDataFrame(
        [("1", "h", 5.0), ("1", None, -1.0), ("2", "h", None), (None, "h", 0.0), (None, "h", 3.0)],
        "booking_id string, hotel_id string, total_price double",
    )
    suite = [quality.expect_unique("booking_id"), quality.expect_not_null("hotel_id"), quality.expect_between("total_price", 0)]
    got = [tuple(r)[3:] for r in quality.run_suite(df, suite).orderBy("position").collect()]
    assert got == [(5, 2, 2, 2 * 100 / 3, False), (5, 1, 1, 20.0, False), (5, 1, 1, 25.0, False)]
    empty = quality.run_suite(df.filter("false"), suite)
    assert [r["success"] for r in empty.collect()] == [True, True, True]
    assert quality.suite_summary(empty).first()["success_percent"] == 100.0


def test_gate(spark):
    bad = spark.createDataFrame([("1",), ("1",)], "booking_id string")
    results = quality.run_suite(bad, [quality.expect_unique("booking_id")])
    with pytest.warns(UserWarning):
        assert quality.gate(results) is False
    with pytest.raises(quality.QualityError):
        quality.gate(results, "raise")
    good = quality.run_suite(bad.limit(1), [quality.expect_unique("booking_id")])
    assert quality.gate(good, "raise") is True


def test_report_files_accumulate(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "booking_id string")
    results = quality.run_suite(df, [quality.expect_unique("booking_id")])
    write_report(results, str(tmp_path / "r"))
    assert write_report(results, str(tmp_path / "r")).count() == 2


def tiny_star(spark):
    fact = spark.createDataFrame(
        [("1", "h1", "Cancelled", 10.0), ("2", "h1", "Confirmed", None), ("3", "h2", "Confirmed", 5.0),
         ("4", "zz", "Pending", 1.0), ("5", "h2", "Cancelled", 4.0)],
        "booking_id string, hotel_id string, booking_status string, total_price_usd double",
    ).withColumns({"booking_date": F.lit("2024-01-01").cast("date"), "customer_id": F.lit("c")})
    hotels = spark.createDataFrame([("h1", "ROME"), ("h2", "UNKNOWN")], "hotel_id string, city string")
    days = spark.createDataFrame([(dt.date(2024, 1, 1), "2024-01")], "date_key date, year_month string")
    customers = spark.createDataFrame([("c", "x")], "customer_id string, full_name string")
    return star.Star(fact, hotels, days, customers)


def test_measures_and_status_override(spark):
    data = tiny_star(spark)
    both = [m.total_bookings(), m.cancellation_rate(), m.avg_revenue()]
    assert rows(m.evaluate(data, (), both)) == [(5, 0.4, 4.0)]
    chosen = m.evaluate(data, (), both, {"booking_status": ["Confirmed"]})
    assert rows(chosen) == [(2, 1.0, 2.5)]
    by_city = m.evaluate(data, ["hotels.city"], [m.total_revenue()])
    assert rows(by_city) == [("ROME", 10.0), ("UNKNOWN", 9.0), (None, 1.0)]
    blank = m.evaluate(data, ["hotels.city"], [m.total_bookings()], {"hotels.city": [None]})
    assert rows(blank) == [(None, 1)]


def test_override_reaches_over_its_own_groups(spark):
    data = tiny_star(spark)
    by_status = m.evaluate(data, ["booking_status"], [m.total_bookings(), m.cancellation_rate()])
    assert rows(by_status) == [("Cancelled", 2, 1.0), ("Confirmed", 2, 1.0), ("Pending", 1, 2.0)]
    both = m.evaluate(data, ["hotels.city", "booking_status"], [m.cancellation_rate()])
    assert rows(both) == [("ROME", "Cancelled", 1.0), ("ROME", "Confirmed", 1.0), ("UNKNOWN", "Cancelled", 1.0),
                          ("UNKNOWN", "Confirmed", 1.0), (None, "Pending", 0.0)]


def test_city_revenues_add_up_to_the_total(spark):
    data = tiny_star(spark)
    parts = m.evaluate(data, ["hotels.city"], [m.total_revenue()]).agg(F.sum("total_revenue")).first()[0]
    assert parts == m.evaluate(data, (), [m.total_revenue()]).first()[0]


def test_profile_and_top(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (3.0, "c"), (None, "d")], "v double, k string")
    assert rows(aggregates.profile(df, ["v"]).select("count", "mean", "min", "max")) == [(3, 7 / 3, 1.0, 3.0)]
    assert [r["k"] for r in aggregates.top_k(df, "v", 2, ["k"]).collect()] == ["a", "c"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", ok', " a ", "x\ny"), (None, "", "z")], "a string, b string, c string")
    path = files.write_raw_csv(df, str(tmp_path / "csv"))
    back = files.read_raw_csv(spark, path, text_schema(["a", "b", "c"]))
    assert rows(back) == rows(spark.createDataFrame([('say "hi", ok', " a ", "x\ny"), (None, None, "z")], df.schema))


def test_append_goes_by_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "n int, t string")
    tables.write_table(df, "append_by_name", path=str(tmp_path / "t"))
    table = tables.write_table(df.select("t", "n"), "append_by_name", "append", path=str(tmp_path / "t"))
    assert rows(table) == [(1, "x"), (1, "x")]


def test_stream_restart_adds_nothing_and_batches_are_limited(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), F.col("id").cast("string").alias("t"))
    source = replay(df.repartition(5), str(tmp_path / "in"))
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):
        landed = landing.land_stream(spark, source, target, checkpoint, df.schema, max_files=2)
        assert rows(landed) == rows(df)
    stream = landing.read_events(spark, source, df.schema, max_files=2)
    batches = landing.land_batches(stream, str(tmp_path / "b"), str(tmp_path / "bcp"))
    assert batches.select("batch_id").distinct().count() == 3
    assert batches.count() == 100


def test_unreadable_events_are_kept(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ('{"a": 2, "new": 3}',)], "value string")
    got = rows(landing.parse_events(df, spark.createDataFrame([], "a int").schema))
    assert got == [(1, None), (2, None), (None, '{"a": ')]


def test_report_keeps_all_values(spark, tmp_path):
    """The document lists the most frequent ones, the table beside it has all."""
    df = spark.range(300).select((F.col("id") % 100).cast("string").alias("booking_id"))
    suite = [quality.expect_unique("booking_id")]
    results, values = quality.run_suite(df, suite), quality.unexpected_values(df, suite)
    folder = str(tmp_path / "reports")
    shape = "run string, unexpected_values array<struct<n_values:bigint,values:array<struct<value:string,rows:bigint>>>>"
    document = write_report(results, folder, values, listed=3).select(F.from_json("value", shape).alias("d")).first()["d"]
    listed = document["unexpected_values"][0]
    assert listed["n_values"] == 100 and [v["value"] for v in listed["values"]] == ["0", "1", "10"]
    assert report_values(spark, folder, document["run"]).count() == 100
    write_report(results, folder, values, limit=7)
    assert report_values(spark, folder).count() == 107


def test_failed_answers_have_a_reason(spark):
    good = '{"daily":{"time":["2024-01-01"],"temperature_2m_max":[1.5],"rain_sum":[0]}}'
    answers = [("a", good), ("b", None), ("c", " "), ("d", good[:-1]), ("e", '{"error":true}'),
               ("f", '{"daily":{"time":[]}}'), ("g", '{"daily":{"time":["soon"]}}'), ("h", "[]")]
    df = spark.createDataFrame(answers, "city string, payload string")
    got = {r["city"]: r["reason"] for r in payloads.weather_failures(df, "city", "payload").collect()}
    assert got == {"b": "missing", "c": "missing", "d": "not json", "e": "no data", "f": "no rows", "g": "no rows", "h": "no data"}
    rates = [("a", '{"rates":{"2024-01-01":{"EUR":0.9}}}'), ("b", '{"rates":{}}'), ("c", '{"rates":{"2024-01-01":{}}}'), ("d", "{")]
    df = spark.createDataFrame(rates, "id string, payload string")
    got = {r["id"]: r["reason"] for r in payloads.rates_failures(df, "payload", "id").collect()}
    assert got == {"b": "no rows", "c": "no rows", "d": "not json"}
    want = spark.createDataFrame([("a",), ("d",), ("x",)], "city string")
    have = spark.createDataFrame([("a",)], "city_name string")
    failed = spark.createDataFrame([("d", "not json"), ("a", "missing")], "city string, reason string")
    asked = backfill.to_ask(want, have, failed, {"city": "city_name"}, "city")
    assert {tuple(r) for r in asked.collect()} == {("d", "not json"), ("x", None)}


def test_failed_overwrite_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "kept")
    tables.write_table(spark.range(5), "kept_table", path=path)
    broken = spark.range(8).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(broken, "kept_table", path=path)
    assert spark.table("kept_table").count() == 5
    # From the table itself, with another schema and partitions.
    table = tables.write_table(
        spark.table("kept_table").select(F.col("id").cast("string").alias("n"), (F.col("id") % 2).alias("odd")),
        "kept_table", path=path, partition_by=["odd"],
    )
    assert {(r["n"], r["odd"]) for r in table.collect()} == {(str(i), i % 2) for i in range(5)}
    assert tables.drop_versions(spark, "kept_table") == 2 and spark.table("kept_table").count() == 5
    tables.write_table(spark.createDataFrame([("9", 1)], "n string, odd long"), "kept_table", "append", path=path)
    assert spark.table("kept_table").where("odd = 1").count() == 3


def test_staged_tables_can_be_removed(tmp_path):
    """In a session of its own folder, so that other tests keep theirs."""
    from unittest.mock import patch

    from pyspark.sql import SparkSession

    from stayledger import storage

    spark = SparkSession.getActiveSession()
    with patch.object(storage, "shared_folder", lambda _: str(tmp_path)):
        assert storage.forget_staged(spark) == 0
        staged = storage.stage_table(spark.range(3), "some")
        assert staged.count() == 3 and storage.forget_staged(spark) == 1
        assert list((tmp_path / storage.STAGED).iterdir()) == []
