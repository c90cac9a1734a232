"""SQL for the checking engine: for each query key, the result it must give.

Each text is a chain of named steps (``STEPS``) and a final select. The raw bookings come
from the portable expressions of the booking view; every later step is written here anew,
row by row and with window functions where the Spark side aggregates and joins.
"""

from __future__ import annotations

import re

from stayledger import constants as C
from stayledger.plans.star import HOTEL_ORDER
from stayledger.schemas import DIM_CUSTOMERS, DIM_HOTELS, FCT_BOOKINGS
from stayledger.sources import bookings as B

DIM_C = ", ".join(DIM_CUSTOMERS.names)
DIM_H = ", ".join(DIM_HOTELS.names)
FCT = ", ".join(FCT_BOOKINGS.names)


# --- expressions ------------------------------------------------------------------------


def edge(v: str) -> str:
    return f"trim(regexp_replace({v}, '{C.EDGE_PATTERN}', '', 'g'))"


def letters(v: str) -> str:
    return f"upper(trim(regexp_replace({v}, '[^a-zA-Z\\s]', '', 'g')))"


def to_int(v: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({v}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)')"
        f" THEN TRY_CAST(trunc(TRY_CAST(trim({v}) AS DOUBLE)) AS INTEGER) END"
    )


def to_double(v: str) -> str:
    return f"TRY_CAST({v} AS DOUBLE)"


LAYOUTS = {
    "yyyy-MM-dd": (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
    "MM/dd/yyyy": (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y"),
    "dd/MM/yyyy": (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
    "yyyy/MM/dd": (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
}


def to_date(v: str, formats=C.CLEANING_DATE_FORMATS) -> str:
    tries = [
        f"CASE WHEN regexp_full_match({v}, '{LAYOUTS[f][0]}') THEN CAST(try_strptime({v}, '{LAYOUTS[f][1]}') AS DATE) END"
        for f in formats
    ]
    return f"coalesce({', '.join(tries)})"


def rating(v: str) -> str:
    text = f"lower(trim({v}))"
    for word, digit in C.RATING_WORDS.items():
        text = f"replace({text}, '{word}', '{digit}')"
    value = to_int(text)
    return f"CASE WHEN ({value}) BETWEEN 1 AND 5 THEN ({value}) END"


def rooms(v: str) -> str:
    return f"CASE WHEN ({to_int(v)}) > 0 AND ({to_int(v)}) < 9999 THEN ({to_int(v)}) END"


def money(v: str) -> str:
    return f"CASE WHEN {to_double(v)} >= 0 THEN {to_double(v)} END"


def guard(v: str, year: int = B.LAST_YEAR) -> str:
    return f"CASE WHEN year({v}) <= {year} THEN {v} END"


def unknown(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN 'Unknown' ELSE {v} END"


def geo(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN 'UNKNOWN' ELSE upper({v}) END"


def needs(v: str) -> str:
    return f"({v} IS NULL OR {v} = 'UNKNOWN')"


def group_min(v: str, over: str) -> str:
    return (
        f"coalesce(min(nullif({v}, '')) OVER (PARTITION BY {over}), min({v}) OVER (PARTITION BY {over}))"
    )


RATE = (
    "CASE WHEN currency_code_map = 'USD' THEN 1.0e0 ELSE coalesce(day_rate, mean_rate, 1.0e0) END"
)
BAND = (
    "CASE WHEN total_price_usd < 150 THEN 'Budget' WHEN total_price_usd < 400 THEN 'Mid-Range' ELSE 'Luxury' END"
)
WEEK = "CAST(floor((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) / 7) AS INTEGER) + 1"
CALENDAR = f"""CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, {WEEK} AS week_of_year,
  dayname(d) AS day_of_week_name, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  strftime(d, '%Y-%m') AS year_month"""


# --- steps ------------------------------------------------------------------------------


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"{v}e0"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def _raw() -> str:
    columns = ",\n  ".join(f"{sql} AS {name}" for name, (_, sql) in B.BOOKING_COLUMNS.items())
    return f"""SELECT k, {columns}
  FROM (SELECT *, {B.K} AS k FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey) AS joined"""


def _replace(source: str, exprs: dict[str, str], where: str = "") -> str:
    changed = ", ".join(f"{sql} AS {name}" for name, sql in exprs.items())
    return f"SELECT * REPLACE ({changed}) FROM {source} {where}"


STEPS = {
    "raw": _raw(),
    "edged": _replace("raw", {c: edge(c) for c in C.EDGE_CLEANED_COLUMNS}),
    "keyed": _replace(
        "edged", {c: unknown(c) for c in C.UNKNOWN_LABEL_COLUMNS},
        "WHERE hotel_id IS NOT NULL AND hotel_id <> '' AND hotel_id <> 'null'",
    ),
    "by_hotel": _replace(
        "keyed",
        {c: f"coalesce({c}, {group_min(c, 'hotel_name')})" for c in ("city", "country")},
    ),
    "by_city": _replace("by_hotel", {"country": f"coalesce(country, {group_min('country', 'city')})"}),
    "city_country": f"SELECT 'CITY ' || CAST(n_nationkey AS STRING) AS lk_city, {B._country('n_nationkey')} AS lk_country FROM nation",
    "country_capital": f"SELECT {B._country('n_nationkey')} AS lk_country, 'CAPITAL ' || CAST(n_nationkey AS STRING) AS lk_capital FROM nation",
    "countried": f"""SELECT b.* REPLACE (
      CASE WHEN {needs('b.country')} THEN h.lk_country ELSE b.country END AS country,
      CASE WHEN {needs('b.country_customer')} THEN c.lk_country ELSE b.country_customer END AS country_customer)
    FROM by_city b LEFT JOIN city_country h ON b.city = h.lk_city LEFT JOIN city_country c ON b.city_customer = c.lk_city""",
    "citied": f"""SELECT b.* REPLACE (
      CASE WHEN {needs('b.city')} THEN h.lk_capital ELSE b.city END AS city,
      CASE WHEN {needs('b.city_customer')} THEN c.lk_capital ELSE b.city_customer END AS city_customer)
    FROM countried b LEFT JOIN country_capital h ON b.country = h.lk_country
      LEFT JOIN country_capital c ON b.country_customer = c.lk_country""",
    "placed": _replace("citied", {c: geo(c) for c in C.GEO_COLUMNS}),
    "dated": _replace("placed", {c: to_date(c) for c in C.DATE_COLUMNS}),
    "fallen": _replace("dated", {"booking_date": "coalesce(booking_date, checkin_date)"}),
    "silver": _replace(
        "fallen",
        {
            **{c: guard(c) for c in C.YEAR_GUARDED_COLUMNS},
            **{c: rating(c) for c in C.RATING_COLUMNS},
            "total_rooms": rooms("total_rooms"),
            **{c: money(c) for c in C.MONEY_COLUMNS if c not in C.ZERO_FILLED_COLUMNS},
            **{c: f"coalesce({money(c)}, 0.0e0)" for c in C.ZERO_FILLED_COLUMNS},
            **{c: f"upper({c})" for c in C.UPPER_ID_COLUMNS},
        },
    ),
    "mapping": f"SELECT * FROM (VALUES {_values(C.COUNTRY_CURRENCY)}) AS m(country_name, currency_code_map)",
    "fixed_rates": f"SELECT * FROM (VALUES {_values(C.FALLBACK_RATES)}) AS f(currency_code, usd_rate)",
    "order_days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)""",
    "ship_days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)""",
    "rates": f"""SELECT d AS rate_date, currency_code, base * (1 + (day(d) % 7) / 100.0e0) AS usd_rate
      FROM order_days, (VALUES {_values(B.DAILY_RATES)}) AS q(currency_code, base) WHERE dayofweek(d) NOT IN (0, 6)""",
    "weather": """SELECT d AS weather_date, 'CITY ' || CAST(n_nationkey AS STRING) AS city_name,
      CAST(10 + (n_nationkey + day(d)) % 20 AS DOUBLE) AS temp_max,
      CASE (n_nationkey + day(d)) % 4 WHEN 0 THEN 1.5e0 WHEN 1 THEN 0.5e0 ELSE 0.0e0 END AS rain_sum
      FROM nation, ship_days WHERE n_regionkey <> 4""",
    "means": "SELECT currency_code, avg(usd_rate) AS mean_rate FROM rates GROUP BY currency_code",
    "coded": "SELECT s.*, m.country_name, m.currency_code_map FROM silver s LEFT JOIN mapping m ON s.country = m.country_name",
    "rated": """SELECT c.*, r.usd_rate AS day_rate, a.mean_rate FROM coded c
      LEFT JOIN rates r ON c.currency_code_map = r.currency_code AND c.booking_date = r.rate_date
      LEFT JOIN means a ON c.currency_code_map = a.currency_code""",
    "priced": f"SELECT * EXCLUDE (day_rate, mean_rate), {RATE} AS effective_rate, total_price * {RATE} AS total_price_usd FROM rated",
    "gold": f"""SELECT p.*, coalesce(w.temp_max, 22.5e0) AS temp_max, coalesce(w.rain_sum, 0.0e0) AS rain_sum,
      coalesce(w.rain_sum, 0.0e0) > 0.5e0 AS is_rainy, {BAND} AS price_category
      FROM priced p LEFT JOIN weather w ON p.city = w.city_name AND p.checkin_date = w.weather_date""",
    "fct": f"SELECT {FCT} FROM gold WHERE booking_id IS NOT NULL",
    "dimc": f"SELECT DISTINCT {DIM_C} FROM gold WHERE customer_id IS NOT NULL",
    "dimh": f"""SELECT {DIM_H} FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY booking_date DESC NULLS LAST,
      {', '.join(f'{c} NULLS FIRST' for c in [*HOTEL_ORDER, *DIM_HOTELS.names[1:]])}) AS rn
      FROM gold WHERE hotel_id IS NOT NULL) WHERE rn = 1""",
    "book_days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(booking_date) AS lo, max(booking_date) AS hi FROM gold)""",
    "dimd": f"SELECT d AS date_key, {CALENDAR} FROM book_days",
}


# Raw bookings after their way through files: a CSV batch reads blanks back as missing,
# a JSON stream sends missing text as blanks.
TRAVELLED_RAW = (
    "SELECT k, "
    + ", ".join(
        f"CASE WHEN k % 10 < 7 THEN nullif({c}, '') ELSE coalesce({c}, '') END AS {c}"
        for c in B.BOOKING_COLUMNS
    )
    + f" FROM ({_raw()}) AS sent"
)


# The same where all rows stay in the session, but those of the stream travel as JSON.
STREAMED_RAW = (
    "SELECT k, "
    + ", ".join(f"CASE WHEN k % 10 < 7 THEN {c} ELSE coalesce({c}, '') END AS {c}" for c in B.BOOKING_COLUMNS)
    + f" FROM ({_raw()}) AS sent"
)
# Daily rates, and every flat rate on each of their days.
ALL_RATES = (
    f"SELECT rate_date, currency_code, usd_rate FROM ({STEPS['rates']}) UNION ALL SELECT d.rate_date, f.currency_code, f.usd_rate"
    f" FROM (SELECT DISTINCT rate_date FROM ({STEPS['rates']})) d, fixed_rates f"
)


def _words(sql: str) -> set[str]:
    return set(re.findall(r"\b[a-z_]+\b", sql)) & set(STEPS)


def chain(sql: str, **replaced: str) -> str:
    """Prefix a select with the steps it needs, in the order they are declared.

    ``replaced`` gives other texts for named steps.
    """
    texts = {**STEPS, **replaced}
    wanted, todo = set(), _words(sql)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo |= _words(texts[name]) - {name} - wanted
    if not wanted:
        return sql
    shared = {"raw", "silver", "gold", "keyed", "by_hotel", "placed"}
    steps = [
        f"{name} AS {'MATERIALIZED ' if name in shared else ''}({text})"
        for name, text in texts.items() if name in wanted
    ]
    return "WITH " + ",\n".join(steps) + "\n" + sql
