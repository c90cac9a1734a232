"""Column functions on literal rows, traps included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayledger.functions import dates, numbers, text


def values(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    rows = df.select("i", fn(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


EDGE_CASES = [
    ("!|?_-#.x", "x"), ("x!|?_-#.", "x"), ("!!!", ""), ("", ""), (None, None), (" a ", "a"),
    (" !x! ", "!x!"), ("a-b_c", "a-b_c"), ("!a!\n", "a\n"), ("!a\n!", "a\n"), ("a!\r\n", "a\r\n"),
    ("\n", "\n"), ("--ünï--", "ünï"), ("a! ", "a!"), ("!a! ", "a "),
]


def test_strip_edges(spark):
    given = [a for a, _ in EDGE_CASES]
    assert values(spark, text.strip_edges, given) == [b for _, b in EDGE_CASES]


def test_strip_edges_equals_the_regular_expression(spark):
    from itertools import product

    from stayledger.constants import EDGE_PATTERN

    given = ["".join(p) for n in range(1, 5) for p in product("!.a \n", repeat=n)]
    want = values(spark, lambda c: F.trim(F.regexp_replace(c, EDGE_PATTERN, "")), given)
    assert values(spark, text.strip_edges, given) == want


def test_letters_key(spark):
    given = ["São Paulo", " new york2", "!x#", None, "123"]
    assert values(spark, text.letters_key, given) == ["SO PAULO", "NEW YORK", "X", None, ""]


def test_has_key(spark):
    assert values(spark, text.has_key, ["h1", "", None, "null", "NULL"]) == [True, False, False, False, True]


def test_labels(spark):
    assert values(spark, text.label_blank, ["", None, "x", " "]) == ["Unknown", "Unknown", "x", " "]
    assert values(spark, text.geo_label, ["", None, "rome"]) == ["UNKNOWN", "UNKNOWN", "ROME"]


def test_missing_values_in_comparisons(spark):
    assert values(spark, lambda c: text.differs_keep_null(c, "UNKNOWN"), ["UNKNOWN", None, "x"]) == [False, True, True]
    assert values(spark, lambda c: text.is_member(c, ["a", None]), ["a", None, "b"]) == [True, True, False]
    assert values(spark, lambda c: text.is_member(c, [None]), ["a", None]) == [False, True]


@pytest.mark.parametrize(
    "given, want",
    [
        ("2024-03-04", dt.date(2024, 3, 4)), ("03/04/2024", dt.date(2024, 3, 4)),
        ("13/04/2024", dt.date(2024, 4, 13)), ("2024/03/04", dt.date(2024, 3, 4)),
        ("2024-02-30", None), ("30/02/1980", None), ("2024-1-5", None), ("24-01-05", None),
        ("2024-01-05 10:00:00", None), (" 2024-01-05", None), ("n/a", None), ("", None), (None, None),
    ],
)
def test_parse_date(spark, given, want):
    assert values(spark, dates.parse_date, [given]) == [want]


def test_parse_date_shapes_refuse_nothing_the_parser_takes(spark):
    from stayledger.constants import CLEANING_DATE_FORMATS

    given = [f"{a}{s}{b}{s}{c}" for s in "-/" for a in ("2024", "02", "31", "00", "1")
             for b in ("02", "29", "13", "7") for c in ("2023", "29", "31", "12", "00")]
    plain = lambda c: F.coalesce(*[F.try_to_date(c, f) for f in CLEANING_DATE_FORMATS])
    assert values(spark, dates.parse_date, given) == values(spark, plain, given)


def test_date_order_is_an_argument(spark):
    day_first = lambda c: dates.parse_date(c, ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy"])
    assert values(spark, day_first, ["03/04/2024", "04/13/2024"]) == [dt.date(2024, 4, 3), dt.date(2024, 4, 13)]


def test_year_guard_and_week(spark):
    given = [dt.date(2025, 12, 31), dt.date(2026, 1, 1), None]
    assert values(spark, dates.null_after_year, given, "date") == [given[0], None, None]
    weeks = values(spark, dates.us_week, [dt.date(2022, 1, 1), dt.date(2022, 1, 2), dt.date(2022, 12, 31)], "date")
    assert weeks == [1, 2, 53]
    assert values(spark, dates.weekend_flag, [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)], "date") == [1, 1, 0]
    assert values(spark, dates.year_month, [dt.date(2024, 1, 6)], "date") == ["2024-01"]


def test_to_int(spark):
    given = ["4", "4.5", "-3.9", " 7 ", "1e1", "1d", "NaN", "abc", "", None, "3000000000", ".5", "5."]
    assert values(spark, numbers.to_int, given) == [4, 4, -3, 7, None, None, None, None, None, None, None, 0, 5]


def test_ratings(spark):
    given = [" five", "THREE ", "4.5", "0", "ten", "none", None, "10", "six", "5", "-1"]
    assert values(spark, numbers.normalize_rating, given) == [5, 3, 4, None, 5, None, None, None, 5, 5, None]


def test_prices(spark):
    given = [None, 149.99, 150.0, 399.99, 400.0]
    assert values(spark, numbers.price_category, given, "double") == ["Luxury", "Budget", "Mid-Range", "Mid-Range", "Luxury"]
    assert values(spark, numbers.is_rainy, [0.5, 0.51, None], "double") == [False, True, False]


def test_rates(spark):
    df = spark.createDataFrame(
        [("USD", 2.0, 3.0), ("EUR", 2.0, 3.0), ("EUR", None, 3.0), (None, None, None)],
        "c string, d double, m double",
    )
    rates = [r[0] for r in df.select(numbers.effective_rate(F.col("c"), F.col("d"), F.col("m"))).collect()]
    assert rates == [1.0, 2.0, 3.0, 1.0]
    both = df.limit(1).select(
        numbers.convert(F.lit(10.0), F.lit(4.0)), numbers.convert(F.lit(10.0), F.lit(4.0), "per_usd")
    ).first()
    assert tuple(both) == (40.0, 2.5)
    with pytest.raises(ValueError):
        numbers.convert(F.lit(1.0), F.lit(1.0), "other")


def test_dates_read_by_cast_and_by_parser(spark):
    """Text as long as its layout is cast, longer years are parsed; both refuse what is no date."""
    texts = {
        "2024-02-29": "2024-02-29", "2023-02-29": None, "02/03/2024": "2024-02-03", "13/03/2024": "2024-03-13",
        "02/30/2024": None, "2024/12/31": "2024-12-31", "2024/12-31": None, "2024-1-05 ": None, "0000-01-01": "0000-01-01",
        "+12345-01-02": "+12345-01-02", "2024-06-01x": None, "": None, None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", dates.parse_date(F.col("t")).cast("string").alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == list(texts.values())
    plan = df.select(dates.parse_date(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(t" in plan and "concat(substring(t" in plan
