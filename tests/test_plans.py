"""Properties of plans and jobs: no fan-out, few stored tables, no sorts of whole tables."""

import re

import pytest
from pyspark.sql import functions as F

from stayledger.checks import inputs
from stayledger.checks.queries import _answers
from stayledger.operators import geo, quality
from stayledger.plans import backfill, enrich, measures, refresh, silver, star
from stayledger.plans.reference import load_rates
from stayledger.schemas import text_schema
from stayledger.sources import bookings as B
from stayledger.sources import files, tables
from stayledger.streaming import landing

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sorts_a_scan(text):
    """A Sort whose rows come from a scan without anything that reduces them between."""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if re.search(r"\bSort \[", line):
            for below in lines[i + 1 :]:
                if re.search(r"Aggregate|Exchange|Join", below):
                    break
                if re.search(r"FileScan|Scan ", below):
                    return True
    return False


def test_group_picks_do_not_sort_whole_tables(spark, tmp_path):
    gold = inputs.gold_table(spark, SF)
    assert not sorts_a_scan(plan(geo.group_values(gold, ["city", "country"], "hotel_name")))
    assert not sorts_a_scan(plan(star.dim_hotels(gold)))


@pytest.mark.parametrize("match", ["exact", "letters"])
def test_repeated_rates_and_weather_keep_the_bookings(spark, match):
    bookings = spark.createDataFrame(
        [("b1", "AUSTRIA", "2020-01-01", "2020-01-02", "CITY 1", 10.0), ("b2", "AUSTRIA", "2020-01-01", "2020-01-02", "CITY 2", 20.0)],
        "booking_id string, country string, booking_date string, checkin_date string, city string, total_price double",
    ).withColumns({c: F.col(c).cast("date") for c in ("booking_date", "checkin_date")})
    rates = spark.createDataFrame([("2020-01-01", "EUR", 0.9)] * 3 + [("2020-01-01", "EUR", 0.8)], "rate_date string, currency_code string, usd_rate double")
    weather = spark.createDataFrame(
        [("2020-01-02", "CITY 1", 5.0, 0.0), ("2020-01-02", "CITY 1", 4.0, 2.0), ("2020-01-02", "CITY 2", 9.0, 1.0)],
        "weather_date string, city_name string, temp_max double, rain_sum double",
    )
    priced = enrich.enrich_currency(bookings, rates)
    got = {r["booking_id"]: r for r in enrich.enrich_weather(priced, weather, match).collect()}
    assert len(got) == 2 and got["b1"]["effective_rate"] == 0.8
    assert got["b1"]["temp_max"] == 4.0 and got["b2"]["temp_max"] == (9.0 if match == "exact" else 4.0)


def test_jobs_store_few_tables(spark, monkeypatch):
    calls = []

    def counted(df, label):
        calls.append(label)
        return stage(df, label)

    stage = geo.stage_table
    monkeypatch.setattr(geo, "stage_table", counted)
    rates, weather = inputs.reference(spark, SF)
    rows = silver.clean_bookings(B.raw_bookings(spark, SF), inputs.lookups(spark, SF), B.LAST_YEAR)
    assert len(calls) <= 4
    enrich.to_gold(rows, rates, weather)
    assert len(calls) <= 7


def test_jobs_do_not_depend_on_partitions(spark):
    columns = ["booking_id", "hotel_name", "city", "country", "city_customer", "country_customer", "booking_date", "hotel_id", "checkin_date"]
    raw = B.raw_bookings(spark, SF, columns)
    one, eight = (
        silver.clean_bookings(raw.repartition(n), inputs.lookups(spark, SF), B.LAST_YEAR) for n in (1, 8)
    )
    assert one.exceptAll(eight).isEmpty() and eight.exceptAll(one).isEmpty()


def test_jobs_run_no_python(spark):
    gold = inputs.gold(spark, SF, "booking_id", "city", "country", "booking_date", "checkin_date", "total_price")
    assert "Python" not in plan(gold) and "Cartesian" not in plan(gold)


def test_rates_are_loaded_once(spark, tmp_path):
    answers, _ = _answers(B.daily_rates(spark, SF), B.daily_weather(spark, SF))
    path = str(tmp_path / "rates")
    first = load_rates(answers, "rates_once", path).collect()
    second = load_rates(answers, "rates_once", path)
    assert sorted(map(tuple, first)) == sorted(map(tuple, second.collect()))
    booking = spark.createDataFrame([("b", "ARGENTINA", 2.0)], "booking_id string, country string, total_price double")
    day = second.agg(F.min("rate_date")).first()[0]
    priced = enrich.enrich_currency(booking.withColumn("booking_date", F.lit(day)), second).first()
    assert priced["effective_rate"] == 850.0 and priced["total_price_usd"] == 1700.0


def test_append_refuses_unknown_columns(spark, tmp_path):
    tables.write_table(spark.range(2), "strict_table", path=str(tmp_path / "strict"))
    with pytest.raises(ValueError, match="extra"):
        tables.write_table(spark.range(2).withColumn("extra", F.lit(1)), "strict_table", "append")
    assert spark.table("strict_table").count() == 2


def test_date_range_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-1-5",), ("2024-02-05 10:00:00",), ("2024-01-20",), ("2024-13-45",), (None,)], "d string")
    strict = backfill.date_range(df, "d").first()
    assert (str(strict["start"]), str(strict["end"])) == ("2024-01-20", "2024-01-20")
    lenient = backfill.date_range(df, "d", lenient=True).first()
    assert (str(lenient["start"]), str(lenient["end"])) == ("2024-01-05", "2024-02-05")


def test_csv_with_inferred_types(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", 2, 3.5)], "name string, n int, x double")
    path = files.write_raw_csv(df, str(tmp_path / "csv"))
    got = files.read_raw_csv(spark, path, None)
    assert dict(got.dtypes) == {"name": "string", "n": "int", "x": "double"}
    assert sorted(map(tuple, got.collect())) == [("a", 1, 2.5), ("b", 2, 3.5)]


def test_strict_gate_stops_the_flow(spark, monkeypatch, tmp_path):
    bad = spark.createDataFrame(
        [("b", None, -1.0, 9, 9)], "booking_id string, hotel_id string, total_price double, star_rating int, review_rating int"
    )
    monkeypatch.setattr(refresh, "to_silver", lambda *_: bad)
    with pytest.raises(quality.QualityError):
        refresh.run_all(spark, bad, bad, None, None, None, str(tmp_path / "flow"), "_strict", on_fail="raise")


def test_gold_is_made_anew_for_changed_files(spark, tmp_path):
    for name in inputs._SOURCES:
        spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = inputs._fingerprint(spark, str(tmp_path))
    assert before == inputs._fingerprint(spark, str(tmp_path))
    spark.range(5).write.mode("append").parquet(str(tmp_path / "nation.parquet"))
    assert before != inputs._fingerprint(spark, str(tmp_path))


def test_landing_rule_for_brokers_and_timers():
    assert landing.broker_options() == {"minOffsetsPerTrigger": "10000", "maxTriggerDelay": "60s"}
    assert landing.landing_trigger(True) == {"processingTime": "60 seconds"}


def test_unexpected_values_are_all_there(spark):
    df = spark.range(100).select((F.col("id") % 50).cast("string").alias("booking_id"))
    suite = [quality.expect_unique("booking_id")]
    assert quality.unexpected_values(df, suite).count() == 50
    assert quality.unexpected_values(df, suite, limit=3).count() == 3


def test_text_schema_is_text():
    assert set(f.dataType.simpleString() for f in text_schema(["a", "b"])) == {"string"}


@pytest.fixture(scope="module")
def stored_star(spark, tmp_path_factory):
    """60 bookings over three months; customers too large to be sent to all executors."""
    bookings = spark.range(60).select(
        F.concat(F.lit("b"), "id").alias("booking_id"), F.concat(F.lit("h"), F.col("id") % 4).alias("hotel_id"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") + F.lit(0)).cast("int")).alias("booking_date"),
        F.col("id").cast("double").alias("total_price_usd"),
    )
    hotels = spark.createDataFrame([("h0", "ROME"), ("h1", "OSLO"), ("h2", None)], "hotel_id string, city string")
    customers = spark.range(7).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("name"), "id").alias("last_name"))
    dates = bookings.select(F.col("booking_date").alias("date_key"), F.date_format("booking_date", "yyyy-MM").alias("year_month"), F.month("booking_date").alias("month")).distinct()
    made = star.Star(bookings, hotels, dates, customers)
    return star.store_star(made, "plan_star", str(tmp_path_factory.mktemp("star")), buckets=4)


def test_selected_months_prune_the_fact(stored_star):
    wanted = [measures.total_revenue(), measures.total_bookings()]
    by_month = measures.evaluate(stored_star, (), wanted, {"dates.month": [2]})
    assert "dynamicpruning" in plan(by_month)
    # The partition's own column is even known before the job starts.
    by_name = measures.evaluate(stored_star, (), wanted, {"dates.year_month": ["2024-02"]})
    assert re.search(r"PartitionFilters: \[[^\]]*booking_month#\d+ = 2024-02", plan(by_name))
    for df in (by_month, by_name):
        assert df.first()["total_bookings"] == 29 and df.first()["total_revenue"] == sum(range(31, 60))


def test_customers_join_where_they_lie(spark, stored_star):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.star_join(stored_star, {"customers": ["last_name"]})
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.where("concat('name', substr(customer_id, 2)) = customers_last_name").count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_facts_are_reduced_before_they_are_summed(spark, stored_star):
    df = measures.evaluate(stored_star, ["customer_id"], [measures.total_bookings()], {"hotels.city": ["ROME"]})
    text = plan(df)
    assert text.index("HashAggregate") < text.index("LeftSemi")
    assert sum(r["total_bookings"] for r in df.collect()) == 15


@pytest.mark.parametrize("cities,want", [(["ROME"], 15), ([None], 30), (["OSLO", None], 45), ([], 0)])
def test_blank_members_of_a_dimension(stored_star, cities, want):
    """Hotel h2 has no city and h3 is no hotel: both are blank."""
    df = measures.evaluate(stored_star, (), [measures.total_bookings()], {"hotels.city": cities})
    assert df.first()["total_bookings"] == want


def test_replaced_selection_on_a_dimension(stored_star):
    share = measures.share_of("hotels.city", ["OSLO"])
    rome, oslo = sum(range(0, 60, 4)), sum(range(1, 60, 4))
    df = measures.evaluate(stored_star, (), [share, measures.total_bookings()], {"hotels.city": ["ROME"]})
    assert df.first()["share"] == rome / oslo and df.first()["total_bookings"] == 15
    by_city = {r["hotels_city"]: r["share"] for r in measures.evaluate(stored_star, ["hotels.city"], [share]).collect()}
    assert by_city["OSLO"] == 1 and by_city["ROME"] == rome / oslo


def test_a_gold_table_of_few_columns_is_enough_for_models(spark, monkeypatch):
    """Charts do not pay for cleaning and storing dozens of columns they never read."""
    monkeypatch.setattr(inputs, "_STORED", {})
    few = inputs.gold_table(spark, SF, "booking_status")
    assert "booking_status" in few.columns and not {"website", "email", "address"} & set(few.columns)
    wanted = [measures.total_revenue(), measures.cancellation_rate()]
    fact = ["booking_id", "booking_status", "total_price_usd", "hotel_id"]
    by_few = measures.evaluate(inputs.star(spark, SF, fact, "hotels"), ["hotels.city"], wanted)
    whole = star.build_star(inputs.gold_table(spark, SF))
    rounded = lambda df: sorted(map(repr, inputs.rounded(df, total_revenue=2, cancellation_rate=6).collect()))
    assert rounded(by_few) == rounded(measures.evaluate(whole, ["hotels.city"], wanted))


def test_buckets_grow_with_the_facts_and_months_have_one_file_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "BUCKET_ROWS", 100)
    rows = spark.range(0, 1200, 1, 8).select(
        F.col("id").cast("string").alias("booking_id"), F.col("id").cast("string").alias("customer_id"),
        F.expr("date_add(date'2024-01-01', int(id % 60))").alias("booking_date"),
    )
    dims = spark.createDataFrame([("h", "c", None)], "hotel_id string, customer_id string, date_key date")
    made = star.store_star(star.Star(rows, dims, dims, dims), "plan_grown", str(tmp_path / "s"), buckets=4)
    described = spark.sql("DESCRIBE EXTENDED plan_grown_fct_bookings").collect()
    assert {"Num Buckets": "12"}.items() <= {r[0]: r[1] for r in described}.items() and made.fact.count() == 1200
    months = [p for p in (tmp_path / "s" / "fct_bookings").iterdir() if "=" in p.name]
    # Each file is of one bucket, and none has two.
    assert len(months) == 2 and all(len(list(m.glob("part-*"))) == 12 for m in months)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaning_steps_are_not_repeated_for_each_mention(spark):
    row = ("!2000-01-02", "03/04/2001", " five", "")
    df = spark.createDataFrame([row], "booking_date string, checkin_date string, star_rating string, hotel_type string")
    cleaned = silver.clean_stateless(df, 2025)
    assert [str(v) for v in cleaned.first()] == ["2000-01-02", "2001-03-04", "5", "Unknown"]
    plan = _optimized(cleaned)
    # Four layouts of two dates, ten words of one rating, the edges of three columns.
    assert plan.count("try_to_date") == 8
    assert plan.count("replace(") - plan.count("regexp_replace(") == 10
    assert plan.count("regexp_replace(") == 3


def test_places_may_be_seen_in_a_narrower_frame(spark):
    rows = [("h1", "a", "X", None, "1"), ("h2", "a", None, "Y", "2"), ("null", "a", "B", "B", "3"), ("h3", None, "Z", None, "4")]
    raw = spark.createDataFrame(rows, "hotel_id string, hotel_name string, city string, country string, total_price string")
    known = silver.Lookups(
        spark.createDataFrame([("Z", "W")], "city string, country string"),
        spark.createDataFrame([("W", "Z")], "country string, capital string"),
    )
    whole = silver.clean_bookings(raw, known).collect()
    narrow = silver.clean_bookings(raw, known, hotels=raw.drop("total_price")).collect()
    assert sorted(whole) == sorted(narrow) and len(narrow) == 3


def test_raw_bookings_write_each_date_and_country_once(spark, tmp_path):
    made = {
        "lineitem": "1L l_orderkey, 1 l_linenumber, 3L l_suppkey, 2.0 l_quantity, 9.5 l_extendedprice, 0.1 l_discount,"
                    " 0.2 l_tax, 'A' l_returnflag, 'O' l_linestatus, date'2001-02-03' l_shipdate",
        "orders": "1L o_orderkey, 2L o_custkey, 'F' o_orderstatus, date'2000-05-06' o_orderdate, 'HIGH' o_orderpriority",
        "supplier": "3L s_suppkey, 's3' s_name, 9 s_nationkey",
        "customer": "2L c_custkey, 'c2' c_name, 24 c_nationkey, 'AUTO' c_mktsegment",
    }
    for name, columns in made.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    columns = ["checkin_date", "review_date", "stay_date", "created_at", "updated_timestamp", "country", "country_customer"]
    df = B.raw_bookings(spark, str(tmp_path), columns)
    row = df.first()
    assert (row["checkin_date"], row["review_date"], row["created_at"]) == ("2001-02-03", "02/03/2001", "2000-05-06")
    assert (row["country"], row["country_customer"], row["updated_timestamp"]) == ("FRANCE", "ATLANTIS", "#2001-02-03 09:30:00")
    plan = _optimized(df)
    assert plan.count("(l_shipdate") == 1 and plan.count("FRANCE") + plan.count("france") == 2


def test_wide_projections_stay_out_of_whole_stage_code(spark):
    """One method of all columns is too large for the JVM to compile; and joins copy the other columns at once."""
    columns = [c for c in B.BOOKING_COLUMNS if c != "k"]
    raw = spark.createDataFrame([("",) * len(columns)], ", ".join(f"{c} string" for c in columns))
    known = silver.Lookups(
        spark.createDataFrame([("Z", "W")], "city string, country string"),
        spark.createDataFrame([("W", "Z")], "country string, capital string"),
    )
    cleaned = silver.clean_bookings(raw.withColumn("hotel_id", F.lit("?h1")), known)
    assert cleaned.columns == columns and cleaned.first()["hotel_id"] == "H1"
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Project [" in line and line.count(", ") > 60]
    assert wide and not [line for line in wide if "*(" in line.split("Project")[0]]
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and "_packed" in plan
