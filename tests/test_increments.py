"""Days that are refreshed, and those that are left alone."""

import os

import pytest
from pyspark.sql import functions as F

from stayledger.plans import increments
from stayledger.plans.enrich import to_gold
from stayledger.plans.silver import Lookups, to_silver

RAW = "booking_id string, hotel_id string, hotel_name string, city string, country string, booking_date string, checkin_date string, total_price string"
ROWS = [
    ("1", "h1", "One", "ROME", "ITALY", "2024-01-01", "2024-02-01", "10"),
    ("2", "h1", "One", None, None, "2024-01-02", "2024-02-01", "20"),
    ("3", "h2", "Two", "OSLO", "NORWAY", "2024-01-03", "2024-02-02", "30"),
    ("4", "h2", "Two", "OSLO", None, "no day", "2024-01-04", "40"),
    ("4", "h2", "Two", "OSLO", None, "no day", "2024-01-04", "40"),
    ("5", "h3", "Three", "LIMA", "PERU", "no day", "no day", "50"),
    ("6", "", "Three", "LIMA", "PERU", "2024-01-01", "no day", "50"),
]


@pytest.fixture
def flow(spark, tmp_path):
    lookups = Lookups(
        spark.createDataFrame([("ROME", "ITALY")], "city string, country string"),
        spark.createDataFrame([("ITALY", "ROME")], "country string, capital string"),
    )
    weather = [("2024-02-01", "ROME", 11.0, 0.0), ("2024-02-02", "OSLO", 1.0, 2.0)]

    def run(rows, rate=0.9, rain=2.0):
        raw = spark.createDataFrame(rows, RAW)
        rates = spark.createDataFrame([("2024-01-01", "EUR", rate), ("2024-01-02", "EUR", 0.5)], "d string, currency_code string, usd_rate double")
        rates = rates.select(F.col("d").cast("date").alias("rate_date"), "currency_code", "usd_rate")
        days = spark.createDataFrame([(*w[:3], rain if w[1] == "OSLO" else w[3]) for w in weather], "d string, city_name string, temp_max double, rain_sum double")
        days = days.select(F.col("d").cast("date").alias("weather_date"), "city_name", "temp_max", "rain_sum")
        silver = increments.silver_by_day(raw, raw.limit(0), lookups, str(tmp_path / "silver"))
        gold = increments.gold_by_day(silver, rates, days, str(tmp_path / "gold"))
        want = to_gold(to_silver(raw, raw.limit(0), lookups), rates, days)
        got = sorted(map(repr, gold.rows.select(want.columns).collect()))
        assert got == sorted(map(repr, want.collect()))
        written = lambda layer: sorted(str(r[0]) for r in layer.changed.select("booking_date").collect())
        return written(silver), written(gold)

    def files(layer):
        top = tmp_path / layer / "days"
        return {str(d)[len(str(top)) :]: tuple(sorted(f)) for d, _, f in os.walk(top) if f and "=" in str(d)}

    return run, files


def test_only_changed_days_are_written(flow):
    run, files = flow
    every = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "None"]
    assert run(ROWS) == (every, every)
    before = files("gold")
    assert run(ROWS) == ([], []) and files("gold") == before
    # A price of one day, a row twice, a rate, rain.
    assert run([*ROWS[:2], (*ROWS[2][:-1], "31"), *ROWS[3:]]) == (["2024-01-03"], ["2024-01-03"])
    after = files("gold")
    assert {d for d in after if after[d] != before[d]} == {"/booking_day=2024-01-03"}
    assert run([*ROWS, ROWS[2]]) == (["2024-01-03"], ["2024-01-03"])
    assert run([*ROWS, ROWS[2]], rain=0.1) == ([], ["2024-01-03"])
    # The mean of all rates counts only for days without one of their own; OSLO's currency has none.
    assert run(ROWS, rate=0.8, rain=0.1) == (["2024-01-03"], ["2024-01-01", "2024-01-03"])


def test_places_and_vanished_days(flow):
    run, files = flow
    run(ROWS)
    # Another city of hotel One on the first day fills the second day's row.
    assert run([(*ROWS[0][:3], "BARI", *ROWS[0][4:]), *ROWS[1:]])[0] == ["2024-01-01", "2024-01-02"]
    assert "None" in run(ROWS[:5])[0] and not any("HIVE" in d for d in files("gold"))
    assert run(ROWS[:2])[1][-2:] == ["2024-01-03", "2024-01-04"]
    assert len(files("silver")) == 2


def test_a_failure_before_the_marks_writes_the_days_again(flow, monkeypatch):
    run, _ = flow
    run(ROWS)
    changed = [*ROWS[:2], (*ROWS[2][:-1], "31"), *ROWS[3:]]
    with monkeypatch.context() as broken:
        broken.setattr(increments, "gold_by_day", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(changed)
    assert run(changed) == ([], ["2024-01-03"])


def test_a_day_has_one_file_however_many_tasks_hold_its_rows(spark, tmp_path):
    rows = spark.range(0, 800, 1, 8).select(
        F.expr("date_add(date'2024-01-01', int(id % 20))").alias("booking_date"), F.col("id").cast("string").alias("x")
    )
    nothing = spark.createDataFrame([], "booking_date date, gone boolean")
    days = increments.Days(spark, str(tmp_path / "layer"))
    days.write(rows, nothing, increments.marks(rows, F.xxhash64("x")))
    found = [len(list(d.glob("part-*"))) for d in (tmp_path / "layer" / "days").iterdir() if "=" in d.name]
    assert found == [1] * 20 and days.read(rows.schema).count() == 800
