"""All registered queries, grouped like the operator inventory."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayledger import constants as C
from stayledger.checks import oracle as sql
from stayledger.checks.inputs import (
    DIMENSION_COLUMNS,
    before_after,
    edged,
    gold,
    gold_table,
    keyed,
    lookups,
    raw,
    reference,
    rounded,
    silver,
    star,
    stored_star,
)
from stayledger.checks.registry import ORACLE, QUERIES, query
from stayledger.functions import dates, numbers, text
from stayledger.operators import aggregates, geo, quality, sets
from stayledger.operators import columns as ops
from stayledger.operators.joins import missing_keys
from stayledger.plans import backfill, dashboard, enrich, increments
from stayledger.plans import measures as m
from stayledger.plans import star as models
from stayledger.plans.reference import load_rates, load_weather
from stayledger.plans.refresh import run_all
from stayledger.plans.silver import bookings_per_year, clean_stateless, rooms
from stayledger.schemas import FCT_BOOKINGS, conform, text_schema
from stayledger.sources import bookings as B
from stayledger.sources import events, files, literals, payloads, reports, tables
from stayledger.storage import stage_table, workspace
from stayledger.streaming import landing, places
from stayledger.streaming.admission import queue_events, read_waiting
from stayledger.streaming.replay import replay

Frame = DataFrame
Spark = SparkSession


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


# --- scans, sources, sinks --------------------------------------------------------------

_CSV = list(B.BOOKING_COLUMNS)


@query("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in _CSV) + " FROM raw")
def scan_csv(spark: Spark, sf: str) -> Frame:
    path = files.write_raw_csv(raw(spark, sf, _CSV), workspace(spark, "csv"))
    return files.read_raw_csv(spark, path, text_schema(_CSV))


@query(
    f"""SELECT upper(s_name) AS hotel, upper({B._country('s_nationkey')}) AS country, s_acctbal AS balance FROM supplier"""
)
def scan_lookup(spark: Spark, sf: str) -> Frame:
    messy = B.table(spark, sf, "supplier").select(
        F.concat(F.lit(" "), F.lower("s_name"), F.lit("  ")).alias("hotel"),
        F.lower(F.expr(B._country("s_nationkey"))).alias("country"),
        F.col("s_acctbal").alias("balance"),
    )
    path = files.write_raw_csv(messy, workspace(spark, "lookup"))
    return files.read_lookup(spark, path, ["hotel", "country"])


@query(
    "SELECT 'lineitem.parquet' AS source_name, count(*) AS rows, count(*) AS stamped FROM lineitem"
)
def provenance(spark: Spark, sf: str) -> Frame:
    scan = files.with_provenance(B.table(spark, sf, "lineitem"))
    name = F.regexp_extract("source_file", r"([^/]+\.parquet)", 1)
    return scan.groupBy(name.alias("source_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("ingestion_timestamp").alias("stamped")
    )


@query("SELECT booking_id, hotel_id, nights FROM raw")
def write_overwrite(spark: Spark, sf: str) -> Frame:
    name, path = _name("overwritten"), workspace(spark, "overwritten")
    tables.write_table(raw(spark, sf, ["booking_id", "total_price"]), name, path=path)
    return tables.write_table(raw(spark, sf, ["booking_id", "hotel_id", "nights"]), name, path=path)


@query("SELECT booking_id, total_price FROM raw")
def write_append(spark: Spark, sf: str) -> Frame:
    name, path = _name("appended"), workspace(spark, "appended")
    rows = raw(spark, sf, ["booking_id", "total_price"], keep=["k"])
    batch, stream = sets.split_batch_stream(rows, in_batch=B.in_batch())
    tables.write_table(batch.select("booking_id", "total_price"), name, path=path)
    return tables.write_table(stream.select("total_price", "booking_id"), name, "append", path=path)


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(f"SELECT *, (SELECT count(*) FROM lineitem) AS total_rows FROM lineitem ORDER BY {_LINE} LIMIT 5")
def sql_count_preview(spark: Spark, sf: str) -> Frame:
    name = _name("lines")
    B.table(spark, sf, "lineitem").createOrReplaceTempView(name)
    total = tables.row_count(spark, name).scalar()
    return tables.preview(spark, name, _LINE).withColumn("total_rows", total)


@query("SELECT * REPLACE (round(total_price_usd, 6) AS total_price_usd) FROM fct")
def materialize_model(spark: Spark, sf: str) -> Frame:
    view = _name("gold")
    gold_table(spark, sf, *FCT_BOOKINGS.names).createOrReplaceTempView(view)
    declared = {"gold_layer.gold_hotel_weather_analytics": view}
    model = models.fct_bookings(tables.source(spark, "gold_layer.gold_hotel_weather_analytics", declared))
    stored = tables.materialize(model, _name("fct"), workspace(spark, "fct"))
    return rounded(stored, total_price_usd=6)


_CONTRACT_TEXT = {
    **{c: c for c in FCT_BOOKINGS.names if c in B.BOOKING_COLUMNS},
    "total_price_usd": "total_price", "temp_max": "paid_amount", "country_name": "country",
    "is_rainy": "is_cancelled", "price_category": "room_type",
}


def _contract_sql(name: str, kind: str, source: str) -> str:
    if kind == "date":
        return f"CASE WHEN regexp_full_match({source}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({source} AS DATE) END AS {name}"
    if kind == "int":
        return f"CASE WHEN regexp_full_match({source}, '\\d+') THEN TRY_CAST({source} AS INTEGER) END AS {name}"
    engine = {"string": "STRING", "double": "DOUBLE", "boolean": "BOOLEAN"}[kind]
    return f"TRY_CAST({source} AS {engine}) AS {name}"


@query(
    "SELECT " + ", ".join(_contract_sql(f.name, f.dataType.simpleString(), _CONTRACT_TEXT[f.name]) for f in FCT_BOOKINGS.fields) + " FROM raw"
)
def conform_fact(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, sorted(set(_CONTRACT_TEXT.values())))
    texts = rows.select(*[F.col(source).alias(name) for name, source in _CONTRACT_TEXT.items()])
    return conform(texts, FCT_BOOKINGS)


_EVENT = list(B.BOOKING_COLUMNS)


@query("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _EVENT) + " FROM raw")
def rows_to_json(spark: Spark, sf: str) -> Frame:
    return landing.parse_events(events.to_events(raw(spark, sf, _EVENT)), text_schema(_EVENT)).drop(landing.CORRUPT)


@query("SELECT booking_id, CASE WHEN k % 10 < 7 THEN 'batch' ELSE 'stream' END AS part FROM raw")
def split_70_30(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id"], keep=["k"])
    batch, stream = sets.split_batch_stream(rows, in_batch=B.in_batch())
    return batch.select("booking_id", F.lit("batch").alias("part")).unionByName(
        stream.select("booking_id", F.lit("stream").alias("part"))
    )


@query(
    """SELECT booking_id AS city_name, CAST(l_shipdate AS DATE) AS weather_date, l_quantity AS temp_max, 0.0e0 AS rain_sum
       FROM (SELECT *, 'bk-' || l_orderkey || '-' || l_linenumber AS booking_id FROM lineitem)
       UNION ALL SELECT booking_id, CAST(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY AS DATE), 0.0e0, l_tax
       FROM (SELECT *, 'bk-' || l_orderkey || '-' || l_linenumber AS booking_id FROM lineitem)"""
)
def flatten_parallel_arrays(spark: Spark, sf: str) -> Frame:
    """Each booking's forecast for two days; one number is missing on either day."""
    day = F.col("l_shipdate").cast("date")
    missing = F.lit(None).cast("double")
    daily = F.struct(
        F.array(day.cast("string"), F.date_add(day, 1).cast("string")).alias("time"),
        F.array(F.col("l_quantity"), missing).alias("temperature_2m_max"),
        F.array(missing, F.col("l_tax")).alias("rain_sum"),
    )
    answers = raw(spark, sf, ["booking_id"], keep=["l_shipdate", "l_quantity", "l_tax"]).select(
        "booking_id", F.to_json(F.struct(daily.alias("daily"))).alias("payload")
    )
    return payloads.flatten_weather(answers, "booking_id", "payload")


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS rate_date, 'EUR' AS currency_code, o_totalprice AS usd_rate FROM orders
       UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), 'GBP', 2.0e0 FROM orders
       UNION ALL SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE), 'EUR', o_totalprice FROM orders"""
)
def flatten_nested_map(spark: Spark, sf: str) -> Frame:
    """Each order's rate answer: two days, with two and one currencies."""
    day = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice")
    by_day = F.create_map(
        day.cast("string"), F.create_map(F.lit("EUR"), price, F.lit("GBP"), F.lit(2.0)),
        F.date_add(day, 1).cast("string"), F.create_map(F.lit("EUR"), price),
    )
    answers = B.table(spark, sf, "orders").select(
        "o_orderkey", F.to_json(F.struct(by_day.alias("rates"))).alias("payload")
    )
    return payloads.flatten_rates(answers, "payload", "o_orderkey")


@query(
    f"""SELECT m.country_name, m.currency_code_map, count(r.booking_id) AS bookings
        FROM mapping m LEFT JOIN raw r ON m.country_name = {sql.letters('r.country')} GROUP BY ALL"""
)
def literal_lookup(spark: Spark, sf: str) -> Frame:
    """Bookings of every mapped country, none left out."""
    counted = (
        raw(spark, sf, ["booking_id", "country"])
        .groupBy(text.letters_key(F.col("country")).alias("country_name"))
        .agg(F.count("booking_id").alias("n"))
    )
    return (
        literals.country_currency(spark)
        .join(counted, "country_name", "left")
        .select("country_name", "currency_code_map", F.coalesce("n", F.lit(0)).alias("bookings"))
    )


# --- projection, filter, imputation -----------------------------------------------------


@query("SELECT booking_id, nights, total_price FROM raw")
def common_cols_union(spark: Spark, sf: str) -> Frame:
    """Batch with typed and extra columns, stream as text in another column order."""
    rows = raw(spark, sf, ["booking_id", "nights", "total_price"], keep=["k"])
    batch, stream = sets.split_batch_stream(rows, in_batch=B.in_batch())
    typed = batch.withColumns(
        {"nights": F.col("nights").cast("int"), "ingestion_timestamp": F.current_timestamp(),
         "source_file": F.lit("batch")}
    ).drop("k")
    return sets.union_sources(typed, stream.select("total_price", "nights", "booking_id"))


_MANY = [c for c in C.EDGE_CLEANED_COLUMNS if c in B.BOOKING_COLUMNS]
_KEY = [] if "booking_id" in _MANY else ["booking_id"]


@query("SELECT " + ", ".join([*_KEY, *(f"{sql.edge(c)} AS {c}" for c in _MANY)]) + " FROM raw")
def edge_clean_many(spark: Spark, sf: str) -> Frame:
    return ops.strip_edges(raw(spark, sf, [*_KEY, *_MANY]), _MANY)


def _before_after_sql(fn, *columns: str) -> str:
    pairs = ", ".join(f"{c} AS {c}_before, {fn(c)} AS {c}_after" for c in columns)
    return f"SELECT booking_id, {pairs} FROM raw"


@query(_before_after_sql(sql.edge, "hotel_id", "country", "booking_status"))
def edge_clean(spark: Spark, sf: str) -> Frame:
    columns = ["hotel_id", "country", "booking_status"]
    return before_after(raw(spark, sf, ["booking_id", *columns]), text.strip_edges, *columns)


@query(_before_after_sql(sql.letters, "city", "country"))
def letters_key(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "city", "country"])
    return before_after(rows, text.letters_key, "city", "country")


@query("SELECT booking_id, hotel_id FROM edged WHERE hotel_id IS NOT NULL AND hotel_id NOT IN ('', 'null')")
def require_key(spark: Spark, sf: str) -> Frame:
    return edged(spark, sf, "booking_id", "hotel_id").transform(ops.require_key, "hotel_id")


_LABELLED = [c for c in C.UNKNOWN_LABEL_COLUMNS if c in B.BOOKING_COLUMNS]


@query("SELECT booking_id, " + ", ".join(f"{sql.unknown(c)} AS {c}" for c in _LABELLED) + " FROM edged")
def fill_unknown(spark: Spark, sf: str) -> Frame:
    return edged(spark, sf, "booking_id", *_LABELLED).transform(ops.fill_unknown, _LABELLED)


@query("SELECT booking_id, " + ", ".join(f"{sql.geo(c)} AS {c}" for c in C.GEO_COLUMNS) + " FROM edged")
def geo_finalize(spark: Spark, sf: str) -> Frame:
    return edged(spark, sf, "booking_id", *C.GEO_COLUMNS).transform(ops.finalize_geo, C.GEO_COLUMNS)


@query(
    f"""SELECT booking_id, CASE WHEN l_quantity BETWEEN 1 AND 5 THEN l_quantity END AS rating_like,
          {sql.rooms('total_rooms')} AS total_rooms, {sql.money('total_price')} AS total_price
        FROM (SELECT r.*, CAST(nights AS DOUBLE) AS l_quantity FROM raw r)"""
)
def range_guard(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "total_rooms", "total_price", "nights"])
    rows = rows.transform(ops.map_columns, ["total_rooms"], rooms)
    rows = rows.transform(ops.non_negative_money, ["total_price"])
    like = numbers.null_outside(F.col("nights").cast("double"), 1, 5)
    return rows.select("booking_id", like.alias("rating_like"), "total_rooms", "total_price")


@query(
    f"""SELECT booking_id, {sql.guard('d', 1998)} AS checkin_date
        FROM (SELECT booking_id, {sql.to_date('checkin_date')} AS d FROM raw)"""
)
def year_guard(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "checkin_date"]).transform(ops.parse_dates, ["checkin_date"])
    return rows.transform(ops.null_after_year, ["checkin_date"], 1998)


@query("SELECT booking_id, coalesce(booking_date, checkin_date) AS booking_date, checkin_date FROM (SELECT booking_id, "
       + ", ".join(f"{sql.to_date(c)} AS {c}" for c in ("booking_date", "checkin_date")) + " FROM raw)")
def fallback_column(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "booking_date", "checkin_date"])
    rows = rows.transform(ops.parse_dates, ["booking_date", "checkin_date"])
    return rows.transform(ops.fill_from_column, "booking_date", "checkin_date")


@query("SELECT booking_id, " + ", ".join(f"coalesce({sql.money(c)}, 0.0e0) AS {c}" for c in C.ZERO_FILLED_COLUMNS) + " FROM raw")
def fill_zero(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", *C.ZERO_FILLED_COLUMNS])
    rows = rows.transform(ops.non_negative_money, C.ZERO_FILLED_COLUMNS)
    return rows.transform(ops.fill_constants, dict.fromkeys(C.ZERO_FILLED_COLUMNS, 0.0))


@query(
    """SELECT booking_id, coalesce(TRY_CAST(tax_amount AS DOUBLE), 22.5e0) AS temp_max,
       coalesce(TRY_CAST(discount_amount AS DOUBLE), 0.0e0) AS rain_sum FROM raw"""
)
def fill_map(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "tax_amount", "discount_amount"]).select(
        "booking_id",
        F.col("tax_amount").try_cast("double").alias("temp_max"),
        F.col("discount_amount").try_cast("double").alias("rain_sum"),
    )
    return rows.transform(ops.fill_constants, C.WEATHER_DEFAULTS)


@query(f"SELECT booking_id, total_price_usd, {sql.BAND} AS price_category FROM (SELECT booking_id, {sql.money('total_price')} AS total_price_usd FROM raw)")
def price_bucket(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "total_price"]).transform(ops.non_negative_money, ["total_price"])
    price = F.col("total_price")
    return rows.select("booking_id", price.alias("total_price_usd"), numbers.price_category(price).alias("price_category"))


@query("""SELECT booking_id, r AS rain_sum, coalesce(r > 0.5e0, false) AS is_rainy
          FROM (SELECT booking_id, TRY_CAST(tax_amount AS DOUBLE) * 10.0e0 AS r FROM raw)""")
def rain_flag(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "tax_amount"])
    rain = F.col("tax_amount").try_cast("double") * 10.0
    return rows.select("booking_id", rain.alias("rain_sum"), numbers.is_rainy(rain).alias("is_rainy"))


@query("SELECT booking_id, hotel_id, country FROM raw WHERE hotel_id IS NOT NULL AND country IS NOT NULL")
def notnull_guard(spark: Spark, sf: str) -> Frame:
    return ops.require_not_null(raw(spark, sf, ["booking_id", "hotel_id", "country"]), "hotel_id", "country")


@query("SELECT booking_id, upper(hotel_id) AS hotel_id, upper(customer_id) AS customer_id FROM edged")
def upper_ids(spark: Spark, sf: str) -> Frame:
    return edged(spark, sf, "booking_id", *C.UPPER_ID_COLUMNS).transform(ops.upper_ids, C.UPPER_ID_COLUMNS)


# --- set operations ---------------------------------------------------------------------


@query(f"SELECT DISTINCT {sql.letters('city')} AS place FROM raw UNION SELECT DISTINCT {sql.letters('country')} FROM raw")
def union_distinct(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["city", "country"])
    cities, countries = (
        rows.select(text.letters_key(F.col(c)).alias("place")) for c in ("city", "country")
    )
    return sets.union_distinct(cities, countries)


# --- joins ------------------------------------------------------------------------------


@query(
    f"""SELECT e.booking_id, CASE WHEN {sql.needs('e.country')} THEN h.lk_country ELSE e.country END AS country,
          CASE WHEN {sql.needs('e.country_customer')} THEN c.lk_country ELSE e.country_customer END AS country_customer
        FROM edged e LEFT JOIN city_country h ON e.city = h.lk_city LEFT JOIN city_country c ON e.city_customer = c.lk_city"""
)
def geo_city_to_country(spark: Spark, sf: str) -> Frame:
    rows = edged(spark, sf, "booking_id", *C.GEO_COLUMNS)
    lookup = lookups(spark, sf).city_country
    rows = geo.fill_from_lookup(rows, "country", "city", lookup, "city", "country")
    rows = geo.fill_from_lookup(rows, "country_customer", "city_customer", lookup, "city", "country")
    return rows.select("booking_id", "country", "country_customer")


@query(
    f"""SELECT e.booking_id, CASE WHEN {sql.needs('e.city')} THEN h.lk_capital ELSE e.city END AS city,
          CASE WHEN {sql.needs('e.city_customer')} THEN c.lk_capital ELSE e.city_customer END AS city_customer
        FROM edged e LEFT JOIN country_capital h ON e.country = h.lk_country
          LEFT JOIN country_capital c ON e.country_customer = c.lk_country"""
)
def geo_country_to_capital(spark: Spark, sf: str) -> Frame:
    rows = edged(spark, sf, "booking_id", *C.GEO_COLUMNS)
    lookup = lookups(spark, sf).country_capital
    rows = geo.fill_from_lookup(rows, "city", "country", lookup, "country", "capital")
    rows = geo.fill_from_lookup(rows, "city_customer", "country_customer", lookup, "country", "capital")
    return rows.select("booking_id", "city", "city_customer")


@query("SELECT booking_id, country, country_name, currency_code_map FROM coded")
def join_currency_map(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "booking_id", "country").transform(enrich.with_currency_code)
    return rows.select("booking_id", "country", "country_name", "currency_code_map")


@query("SELECT booking_id, booking_date, currency_code_map, round(day_rate, 6) AS day_rate FROM rated")
def join_rates(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "booking_id", "country", "booking_date").transform(enrich.with_currency_code)
    rows = rows.transform(enrich.join_rates, B.daily_rates(spark, sf))
    return rounded(rows.select("booking_id", "booking_date", "currency_code_map", "day_rate"), day_rate=6)


@query("SELECT booking_id, currency_code_map, round(mean_rate, 6) AS mean_rate FROM rated")
def join_mean_rate(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "booking_id", "country").transform(enrich.with_currency_code)
    rows = rows.transform(enrich.join_mean_rate, B.daily_rates(spark, sf))
    return rounded(rows.select("booking_id", "currency_code_map", "mean_rate"), mean_rate=6)


@query(
    f"""SELECT 'city' AS kind, city AS name FROM (SELECT DISTINCT {sql.letters('city')} AS city FROM raw)
          WHERE city <> '' AND city NOT IN (SELECT {sql.letters('city_name')} FROM weather)
        UNION ALL SELECT 'hotel city', city FROM (SELECT DISTINCT city FROM raw)
          WHERE city IS NOT NULL AND city NOT IN (SELECT city_name FROM weather)
        UNION ALL SELECT 'currency', currency_code_map FROM (SELECT DISTINCT currency_code_map FROM mapping)
          WHERE currency_code_map NOT IN (SELECT currency_code FROM rates)"""
)
def gap_anti(spark: Spark, sf: str) -> Frame:
    """Cities without weather, by letters-only and by full name; currencies without rates."""
    cities = raw(spark, sf, ["city"])
    weather = B.daily_weather(spark, sf)
    lettered = cities.select(text.letters_key(F.col("city")).alias("name")).filter("name <> ''").distinct()
    by_letters = weather.select(text.letters_key(F.col("city_name")).alias("city_name"))
    full = cities.select(F.col("city").alias("name")).filter("name IS NOT NULL").distinct()
    codes = literals.country_currency(spark).select(F.col("currency_code_map").alias("name")).distinct()

    def gaps(kind: str, want: Frame, have: Frame, column: str) -> Frame:
        return missing_keys(want, have, {"name": column}).select(F.lit(kind).alias("kind"), "name")

    return (
        gaps("city", lettered, by_letters, "city_name")
        .unionByName(gaps("hotel city", full, weather, "city_name"))
        .unionByName(gaps("currency", codes, B.daily_rates(spark, sf), "currency_code"))
    )


@query(
    """SELECT country_name, currency_code_map, currency_code_map IN (SELECT currency_code FROM rates) AS has_rate,
         (SELECT count(DISTINCT country_name) FROM mapping WHERE currency_code_map IN (SELECT currency_code FROM rates)) AS covered
       FROM mapping"""
)
def covered_countries(spark: Spark, sf: str) -> Frame:
    rates = B.daily_rates(spark, sf)
    covered = backfill.covered_count(rates).scalar()
    return backfill.rate_coverage(rates).withColumn("covered", covered)


@query(
    """SELECT rate_date, currency_code, round(usd_rate, 6) AS usd_rate FROM rates
       UNION ALL SELECT d.rate_date, f.currency_code, f.usd_rate FROM (SELECT DISTINCT rate_date FROM rates) d, fixed_rates f"""
)
def densify_rates(spark: Spark, sf: str) -> Frame:
    """Daily rates with all flat rates appended, twice, which adds them once."""
    once = backfill.append_fallback_rates(B.daily_rates(spark, sf))
    twice = backfill.append_fallback_rates(stage_table(once, "rates"))
    return rounded(twice, usd_rate=6)


@query(
    """SELECT booking_id, hotel_id, f.booking_date, f.customer_id, h.city AS hotels_city, d.year_month AS dates_year_month,
         c.last_name AS customers_last_name
       FROM fct f LEFT JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid
       LEFT JOIN dimd d ON f.booking_date = d.date_key
       LEFT JOIN (SELECT customer_id AS cid, min(last_name) AS last_name FROM dimc GROUP BY customer_id) c ON f.customer_id = c.cid"""
)
def star_join(spark: Spark, sf: str) -> Frame:
    wanted = {"hotels": ["city"], "dates": ["year_month"], "customers": ["last_name"]}
    fact = ["booking_id", "hotel_id", "booking_date", "customer_id"]
    return models.star_join(star(spark, sf, fact, *wanted), wanted).select(
        "booking_id", "hotel_id", "booking_date", "customer_id",
        "hotels_city", "dates_year_month", "customers_last_name",
    )


@query(
    """SELECT booking_id, f.customer_id, total_price_usd, c.last_name AS customers_last_name, h.city AS hotels_city
       FROM (SELECT * REPLACE (round(total_price_usd, 6) AS total_price_usd) FROM fct) f
       LEFT JOIN (SELECT customer_id AS cid, min(last_name) AS last_name FROM dimc GROUP BY customer_id) c ON f.customer_id = c.cid
       LEFT JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid"""
)
def star_join_stored(spark: Spark, sf: str) -> Frame:
    """Facts with customers and hotels from the stored star, where facts and customers lie bucket by bucket."""
    joined = models.star_join(stored_star(spark, sf), {"customers": ["last_name"], "hotels": ["city"]})
    wanted = joined.select("booking_id", "customer_id", "total_price_usd", "customers_last_name", "hotels_city")
    return rounded(wanted, total_price_usd=6)


@query(
    """SELECT d - (SELECT min(d) FROM ship_days) AS num, d AS day, count(l_orderkey) AS checkins
       FROM ship_days LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = d GROUP BY d"""
)
def number_series(spark: Spark, sf: str) -> Frame:
    """Day counter from 0 over the whole check-in period, with the check-ins of each day."""
    lines = B.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    span = lines.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    series = span.select("lo", models.numbers(F.lit(0), F.datediff("hi", "lo")))
    days = series.select(F.col("num").cast("long").alias("num"), F.date_add("lo", F.col("num")).alias("day"))
    counted = lines.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return days.join(counted, "day", "left").select("num", "day", F.coalesce("n", F.lit(0)).alias("checkins"))


# --- aggregates, sorts, limits ----------------------------------------------------------


@query(
    """SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM keyed) AS kept_rows,
         (SELECT count(*) FROM raw) - (SELECT count(*) FROM keyed) AS dropped_rows"""
)
def row_count(spark: Spark, sf: str) -> Frame:
    """Rows before and after the key filter in one pass."""
    rows = edged(spark, sf, "hotel_id")
    kept = F.count(F.when(text.has_key(F.col("hotel_id")), 1))
    total = F.count(F.lit(1))
    return rows.agg(total.alias("raw_rows"), kept.alias("kept_rows"), (total - kept).alias("dropped_rows"))


@query(
    f"""SELECT city_clean, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon
        FROM (SELECT {sql.letters("translate(city, '0123456789', 'ABCDEFGHIJ')")} AS city_clean, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon FROM raw)
        WHERE city_clean IS NOT NULL AND city_clean <> '' GROUP BY city_clean"""
)
def city_centroid(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["city", "latitude", "longitude"], keep=["k"])
    # The given names differ in digits only, which the key leaves out.
    rows = rows.withColumn("city", F.translate("city", "0123456789", "ABCDEFGHIJ"))
    batch, stream = sets.split_batch_stream(rows, in_batch=B.in_batch())
    return rounded(backfill.city_centroid(batch, stream), lat=6, lon=6)


@query("SELECT CAST(year(booking_date) AS INTEGER) AS year, count(*) AS count FROM silver GROUP BY 1")
def count_by_year(spark: Spark, sf: str) -> Frame:
    return bookings_per_year(silver(spark, sf, "booking_date"))


_RANGE_SQL = sql.to_date("trim(booking_date)", C.RANGE_DATE_FORMATS)


@query(f"SELECT min(d) AS start, max(d) AS \"end\" FROM (SELECT {_RANGE_SQL} AS d FROM raw)")
def date_range(spark: Spark, sf: str) -> Frame:
    return backfill.date_range(raw(spark, sf, ["booking_date"]), "booking_date")


@query(f"SELECT DISTINCT country FROM (SELECT {sql.letters('country')} AS country FROM raw) WHERE country <> ''")
def distinct_values(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["country"], keep=["k"])
    return backfill.country_list(*sets.split_batch_stream(rows, in_batch=B.in_batch()))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 2) AS mean,"
        f" round(stddev_samp({c}), 2) AS stddev, min({c}) AS min, max({c}) AS max FROM silver"
        for c in C.MONEY_COLUMNS
    )
)
def profile_numeric(spark: Spark, sf: str) -> Frame:
    stats = aggregates.profile(silver(spark, sf, *C.MONEY_COLUMNS), C.MONEY_COLUMNS)
    return rounded(stats, mean=2, stddev=2)


@query(
    """SELECT total_rooms, booking_id, total_price FROM silver
       ORDER BY total_rooms DESC NULLS LAST, booking_id NULLS FIRST, total_price NULLS FIRST LIMIT 10"""
)
def top_k_rooms(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "total_rooms", "booking_id", "total_price")
    return aggregates.top_k(rows, "total_rooms", 10, ["booking_id", "total_price"])


# --- group fills and models -------------------------------------------------------------


@query("SELECT booking_id, hotel_name, city, country FROM by_hotel")
def fill_by_hotel(spark: Spark, sf: str) -> Frame:
    rows = keyed(spark, sf, "booking_id", "hotel_name", "city", "country")
    return geo.fill_within_group(rows, ["city", "country"], "hotel_name")


@query("SELECT booking_id, city, country FROM by_city")
def fill_by_city(spark: Spark, sf: str) -> Frame:
    rows = fill_by_hotel(spark, sf).select("booking_id", "city", "country")
    return geo.fill_within_group(rows, ["country"], "city")


_USD = "round(total_price_usd, 6) AS total_price_usd"


@query("SELECT * FROM dimc")
def dim_customers(spark: Spark, sf: str) -> Frame:
    return models.dim_customers(gold_table(spark, sf, *DIMENSION_COLUMNS["customers"]))


@query("SELECT * FROM dimd")
def dim_date(spark: Spark, sf: str) -> Frame:
    return models.dim_date(gold_table(spark, sf, *DIMENSION_COLUMNS["dates"]))


@query("SELECT * FROM dimh")
def dim_hotels(spark: Spark, sf: str) -> Frame:
    return models.dim_hotels(gold_table(spark, sf, *DIMENSION_COLUMNS["hotels"]))


@query(f"SELECT * REPLACE ({_USD}) FROM fct")
def fct_bookings(spark: Spark, sf: str) -> Frame:
    return rounded(models.fct_bookings(gold_table(spark, sf, *FCT_BOOKINGS.names)), total_price_usd=6)


# --- measures and dashboard -------------------------------------------------------------


def _measure(spark: Spark, sf: str, measure: m.Measure, digits: int | None, *columns: str) -> Frame:
    df = m.evaluate(star(spark, sf, columns), (), [measure])
    return df if digits is None else rounded(df, **{measure.name: digits})


_REVENUE = "round(sum(total_price_usd), 0)"
_CANCELLED = "count(CASE WHEN booking_status = 'Cancelled' THEN booking_id END)"


@query(f"SELECT {_REVENUE} AS total_revenue FROM fct")
def m_total_revenue(spark: Spark, sf: str) -> Frame:
    return _measure(spark, sf, m.total_revenue(), 0, "total_price_usd")


@query("SELECT count(booking_id) AS total_bookings FROM fct")
def m_total_bookings(spark: Spark, sf: str) -> Frame:
    return _measure(spark, sf, m.total_bookings(), None, "booking_id")


@query("SELECT round(sum(total_price_usd) / count(booking_id), 2) AS avg_revenue FROM fct")
def m_avg_revenue(spark: Spark, sf: str) -> Frame:
    return _measure(spark, sf, m.avg_revenue(), 2, "total_price_usd", "booking_id")


@query(f"SELECT round({_CANCELLED} / count(booking_id), 8) AS cancellation_rate FROM fct")
def m_cancellation_rate(spark: Spark, sf: str) -> Frame:
    return _measure(spark, sf, m.cancellation_rate(), 8, "booking_id", "booking_status")


@query("SELECT round(sum(tax_amount), 2) AS sum_tax_amount, round(avg(temp_max), 6) AS avg_temp_max, count(booking_id) AS count_booking_id FROM fct")
def m_implicit_aggs(spark: Spark, sf: str) -> Frame:
    wanted = [m.implicit("tax_amount", "sum"), m.implicit("temp_max", "avg"), m.implicit("booking_id", "count")]
    return rounded(m.evaluate(star(spark, sf, ["tax_amount", "temp_max", "booking_id"]), (), wanted), sum_tax_amount=2, avg_temp_max=6)


@query(
    f"""SELECT price_category, round(sum(CASE WHEN s THEN total_price_usd END), 0) AS total_revenue,
          count(CASE WHEN s THEN booking_id END) AS total_bookings,
          round({_CANCELLED} / nullif(count(CASE WHEN s THEN booking_id END), 0), 8) AS cancellation_rate
        FROM (SELECT f.*, booking_status = 'Confirmed' AS s FROM fct f LEFT JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid
              WHERE is_rainy = false AND (h.city IN ('CITY 1', 'CITY 2', 'UNKNOWN') OR h.city IS NULL))
        GROUP BY price_category"""
)
def filter_context(spark: Spark, sf: str) -> Frame:
    """Selections on fact and dimension; the rate's own status test replaces the status one."""
    filters = {
        "booking_status": ["Confirmed"], "is_rainy": [False],
        "hotels.city": ["CITY 1", "CITY 2", "UNKNOWN", None],
    }
    wanted = [m.total_revenue(), m.total_bookings(), m.cancellation_rate()]
    fact = ["booking_id", "total_price_usd", "booking_status", "is_rainy", "price_category", "hotel_id"]
    df = m.evaluate(star(spark, sf, fact, "hotels"), ["price_category"], wanted, filters)
    return rounded(df, total_revenue=0, cancellation_rate=8)


@query(
    """SELECT hotels_city, dates_year, round(sum(total_price_usd), 0) AS total_revenue, count(booking_id) AS total_bookings
       FROM (SELECT f.*, h.city AS hotels_city, d.year AS dates_year FROM fct f JOIN dimd d ON f.booking_date = d.date_key
             JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid
             WHERE d.year IN (1995, 1996) AND d.quarter = 3 AND h.city IN ('CITY 1', 'CITY 2', 'CITY 5', 'CITY 8', 'CITY 21'))
       GROUP BY hotels_city, dates_year"""
)
def filter_context_pruned(spark: Spark, sf: str) -> Frame:
    """Selected quarters and cities on the stored star: months that are not selected are not read."""
    filters = {
        "dates.year": [1995, 1996],
        "dates.quarter": [3],
        "hotels.city": ["CITY 1", "CITY 2", "CITY 5", "CITY 8", "CITY 21"],
    }
    wanted = [m.total_revenue(), m.total_bookings()]
    df = m.evaluate(stored_star(spark, sf), ["hotels.city", "dates.year"], wanted, filters)
    return rounded(df, total_revenue=0)


_BASE = "sum(CASE WHEN h.city IN ('CITY 1', 'CITY 2') THEN total_price_usd END)"


@query(
    f"""SELECT price_category, round(share, 8) AS share, total_bookings
        FROM (SELECT price_category, sum(CASE WHEN h.city = 'CITY 3' THEN total_price_usd END) / {_BASE} AS share,
                count(CASE WHEN h.city = 'CITY 3' THEN booking_id END) AS total_bookings, {_BASE} AS base
              FROM fct f LEFT JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid
              WHERE is_rainy = false GROUP BY price_category)
        WHERE total_bookings > 0 OR base > 0"""
)
def filter_context_replaced(spark: Spark, sf: str) -> Frame:
    """A measure that replaces the city selected on the hotels by cities of its own."""
    wanted = [m.share_of("hotels.city", ["CITY 1", "CITY 2"]), m.total_bookings()]
    filters = {"hotels.city": ["CITY 3"], "is_rainy": [False]}
    fact = ["booking_id", "total_price_usd", "is_rainy", "price_category", "hotel_id"]
    return rounded(m.evaluate(star(spark, sf, fact, "hotels"), ["price_category"], wanted, filters), share=8)


@query("SELECT booking_id, price_category, is_rainy FROM fct WHERE is_rainy AND price_category IN ('Budget', 'Luxury')")
def slicer_filter(spark: Spark, sf: str) -> Frame:
    columns = ["booking_id", "price_category", "is_rainy"]
    rows = models.fct_bookings(gold_table(spark, sf, *columns), columns)
    picked = text.is_member(F.col("price_category"), ["Budget", "Luxury"]) & text.is_member(F.col("is_rainy"), [True])
    return rows.filter(picked).select("booking_id", "price_category", "is_rainy")


_KPI = f"""SELECT {_REVENUE} AS total_revenue, count(booking_id) AS total_bookings,
  round(sum(total_price_usd) / count(booking_id), 2) AS avg_revenue,
  round({_CANCELLED} / count(booking_id), 8) AS cancellation_rate, round(avg(temp_max), 6) AS avg_temp_max FROM fct"""


@query(_KPI)
def kpi_card(spark: Spark, sf: str) -> Frame:
    return rounded(
        dashboard.kpi_card(star(spark, sf, ["total_price_usd", "booking_id", "booking_status", "temp_max"])),
        total_revenue=0, avg_revenue=2, cancellation_rate=8, avg_temp_max=6,
    )


@query(_KPI, key="entry")
def flagship(spark: Spark, sf: str) -> Frame:
    """The KPI card straight from the raw tables, reading only the columns it needs."""
    columns = ["booking_id", "total_price", "booking_status", "booking_date", "checkin_date", "country", "city"]
    fact = gold(spark, sf, *columns).filter("booking_id IS NOT NULL")
    facts_only = models.Star(fact)
    return rounded(
        dashboard.kpi_card(facts_only),
        total_revenue=0, avg_revenue=2, cancellation_rate=8, avg_temp_max=6,
    )


_BY_CITY = f"""SELECT h.city, {_REVENUE} AS total_revenue FROM fct f
  LEFT JOIN (SELECT hotel_id AS hid, city FROM dimh) h ON f.hotel_id = h.hid"""


@query(_BY_CITY + " WHERE h.city IS DISTINCT FROM 'UNKNOWN' GROUP BY h.city")
def revenue_by_city(spark: Spark, sf: str) -> Frame:
    return rounded(dashboard.revenue_by_city(star(spark, sf, ["total_price_usd", "hotel_id"], "hotels")), total_revenue=0)


@query(_BY_CITY + " GROUP BY h.city")
def revenue_map(spark: Spark, sf: str) -> Frame:
    return rounded(dashboard.revenue_map(star(spark, sf, ["total_price_usd", "hotel_id"], "hotels")), total_revenue=0)


@query(
    """SELECT d.year_month, round(sum(total_price_usd), 0) AS sum_total_price_usd FROM fct f
       LEFT JOIN dimd d ON f.booking_date = d.date_key GROUP BY d.year_month"""
)
def revenue_by_month(spark: Spark, sf: str) -> Frame:
    return rounded(dashboard.revenue_by_month(star(spark, sf, ["total_price_usd", "booking_date"], "dates")), sum_total_price_usd=0)


@query(
    """SELECT checkin_date, is_rainy, count(booking_id) AS bookings, round(avg(temp_max), 6) AS avg_temp_max
       FROM fct WHERE checkin_date < DATE '2000-01-10' GROUP BY ALL"""
)
def bookings_weather_combo(spark: Spark, sf: str) -> Frame:
    fact = ["booking_id", "temp_max", "checkin_date", "is_rainy"]
    return rounded(dashboard.bookings_weather_combo(star(spark, sf, fact), "2000-01-10"), avg_temp_max=6)


@query(
    """SELECT price_category, count(booking_id) AS bookings,
         round(count(booking_id) / (SELECT count(booking_id) FROM fct), 8) AS share FROM fct GROUP BY price_category"""
)
def bookings_by_category(spark: Spark, sf: str) -> Frame:
    return rounded(dashboard.bookings_by_category(star(spark, sf, ["booking_id", "price_category"])), share=8)


@query(
    """SELECT DISTINCT 'price_category' AS slicer, price_category AS member FROM fct
       UNION ALL SELECT DISTINCT 'city', city FROM dimh UNION ALL SELECT DISTINCT 'is_rainy', CAST(is_rainy AS STRING) FROM fct"""
)
def slicer_values(spark: Spark, sf: str) -> Frame:
    data = star(spark, sf, ["price_category", "is_rainy"], "hotels")
    parts = [("price_category", data.fact), ("city", data.hotels), ("is_rainy", data.fact)]
    frames = [
        dashboard.slicer_values(df, c).select(F.lit(c).alias("slicer"), F.col(c).cast("string").alias("member"))
        for c, df in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# --- scalar functions -------------------------------------------------------------------


@query(
    """SELECT booking_id, regexp_replace(hotel_facilities, '[,"]', '', 'g') AS replaced, trim(star_rating) AS trimmed,
         upper(room_type) AS uppered, lower(payment_status) AS lowered FROM raw"""
)
def fn_string(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "hotel_facilities", "star_rating", "room_type", "payment_status"])
    return rows.select(
        "booking_id",
        F.regexp_replace("hotel_facilities", '[,"]', "").alias("replaced"),
        F.trim("star_rating").alias("trimmed"),
        F.upper("room_type").alias("uppered"),
        F.lower("payment_status").alias("lowered"),
    )


@query(_before_after_sql(sql.rating, "star_rating", "review_rating"))
def rating_words(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "star_rating", "review_rating"])
    return before_after(rows, numbers.normalize_rating, "star_rating", "review_rating")


@query("SELECT booking_id, " + ", ".join(f"{sql.to_date(c)} AS {c}" for c in C.DATE_COLUMNS) + " FROM edged")
def date_parse_silver(spark: Spark, sf: str) -> Frame:
    return edged(spark, sf, "booking_id", *C.DATE_COLUMNS).transform(ops.parse_dates, C.DATE_COLUMNS)


@query(f"SELECT booking_id, {_RANGE_SQL} AS booking_date FROM raw")
def date_parse_api(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "booking_date"]).withColumn("booking_date", F.trim("booking_date"))
    return rows.transform(ops.parse_dates, ["booking_date"], C.RANGE_DATE_FORMATS)


@query(
    f"""SELECT booking_id, {sql.to_int('total_rooms')} AS total_rooms, {sql.to_int('star_rating')} AS star_rating,
          {sql.to_int('review_rating')} AS review_rating, {sql.to_double('total_price')} AS total_price FROM raw"""
)
def safe_cast(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "total_rooms", "star_rating", "review_rating", "total_price"])
    rows = rows.transform(ops.map_columns, ["total_rooms", "star_rating", "review_rating"], numbers.to_int)
    return rows.transform(ops.map_columns, ["total_price"], numbers.to_double)


@query(
    """SELECT booking_id, coalesce(promotion_code, cancellation_reason, 'none') AS first_known,
         CASE WHEN booking_status = 'Confirmed' THEN 1 WHEN booking_status = 'Pending?' THEN 2 ELSE 0 END AS status_code,
         gender IS NULL AS no_gender FROM raw"""
)
def fn_conditional(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "promotion_code", "cancellation_reason", "booking_status", "gender"])
    status = F.col("booking_status")
    return rows.select(
        "booking_id",
        F.coalesce("promotion_code", "cancellation_reason", F.lit("none")).alias("first_known"),
        F.when(status == "Confirmed", 1).when(status == "Pending?", 2).otherwise(0).alias("status_code"),
        F.col("gender").isNull().alias("no_gender"),
    )


@query(f"SELECT l_orderkey, d AS day, {sql.CALENDAR} FROM (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d FROM lineitem)")
def fn_date_parts(spark: Spark, sf: str) -> Frame:
    rows = B.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"))
    return rows.select("*", *[c.alias(n) for n, c in dates.calendar_parts(F.col("day")).items()])


@query(
    """SELECT l_orderkey, d AS same_day, CAST(d + INTERVAL 10 DAY AS DATE) AS ten_later
       FROM (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d FROM lineitem)"""
)
def fn_date_add(spark: Spark, sf: str) -> Frame:
    day = F.col("l_shipdate").cast("date")
    return B.table(spark, sf, "lineitem").select(
        "l_orderkey", F.add_months(day, 0).alias("same_day"), F.date_add(day, 10).alias("ten_later")
    )


# --- data quality -----------------------------------------------------------------------


def _check_sql(position: int, e: quality.Expectation, source: str) -> str:
    c = e.column
    if e.kind == quality.UNIQUE:
        bad = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1)"
    elif e.kind == quality.NOT_NULL:
        bad = f"count(*) - count({c})"
    else:
        tests = [f"{c} < {e.low}"] if e.low is not None else []
        tests += [f"{c} > {e.high}"] if e.high is not None else []
        bad = f"count(CASE WHEN {' OR '.join(tests)} THEN 1 END)"
    judged = "count(*)" if e.kind == quality.NOT_NULL else f"count({c})"
    return (
        f"SELECT {position} AS position, '{e.kind}' AS expectation, '{c}' AS \"column\", count(*) AS element_count,"
        f" count(*) - count({c}) AS missing_count, CAST({bad} AS BIGINT) AS unexpected_count, {judged} AS judged FROM {source}"
    )


def _suite_sql(suite, source: str) -> str:
    rows = " UNION ALL ".join(_check_sql(i, e, source) for i, e in enumerate(suite))
    return (
        "SELECT position, expectation, \"column\", element_count, missing_count, unexpected_count,"
        " round(coalesce(unexpected_count * 100.0e0 / nullif(judged, 0), 0.0e0), 4) AS unexpected_percent,"
        f" unexpected_count = 0 AS success FROM ({rows})"
    )


_DQ_COLUMNS = list(dict.fromkeys(e.column for e in quality.SILVER_SUITE))
_RAW_SUITE = (quality.expect_between("nights", 2, 40), quality.expect_between("total_price", 0))
_RAW_STEP = f"(SELECT {sql.to_double('nights')} AS nights, {sql.to_double('total_price')} AS total_price FROM raw)"


def _checked(df: Frame) -> Frame:
    return rounded(df, unexpected_percent=4)


@query(_suite_sql([quality.expect_unique("booking_id")], "raw"))
def dq_unique(spark: Spark, sf: str) -> Frame:
    return _checked(quality.run_suite(raw(spark, sf, ["booking_id"]), [quality.expect_unique("booking_id")]))


@query(_suite_sql([quality.expect_not_null("hotel_id")], "raw"))
def dq_not_null(spark: Spark, sf: str) -> Frame:
    return _checked(quality.run_suite(raw(spark, sf, ["hotel_id"]), [quality.expect_not_null("hotel_id")]))


@query(_suite_sql(_RAW_SUITE, _RAW_STEP))
def dq_between(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["nights", "total_price"]).transform(ops.map_columns, ["nights", "total_price"], numbers.to_double)
    return _checked(quality.run_suite(rows, _RAW_SUITE))


@query(_suite_sql(quality.SILVER_SUITE, "silver"))
def dq_suite(spark: Spark, sf: str) -> Frame:
    return _checked(quality.run_suite(silver(spark, sf, *_DQ_COLUMNS), quality.SILVER_SUITE))


@query(
    f"""SELECT count(*) AS evaluated, count(CASE WHEN success THEN 1 END) AS successful, bool_and(success) AS success,
          round(count(CASE WHEN success THEN 1 END) * 100.0e0 / count(*), 4) AS success_percent
        FROM ({_suite_sql(quality.SILVER_SUITE, 'silver')})"""
)
def dq_summary(spark: Spark, sf: str) -> Frame:
    results = quality.run_suite(silver(spark, sf, *_DQ_COLUMNS), quality.SILVER_SUITE)
    return rounded(quality.suite_summary(results), success_percent=4)


@query(
    " UNION ALL ".join(
        f"SELECT '{model}' AS model, \"column\", expectation AS test, unexpected_count AS failures, success FROM ({_suite_sql(suite, step)})"
        for model, step, suite in (
            ("fct_bookings", "fct", quality.MODEL_SUITES["fct_bookings"]),
            ("dim_customers", "dimc", quality.MODEL_SUITES["dim_customers"]),
            ("dim_hotels", "dimh", quality.MODEL_SUITES["dim_hotels"]),
        )
    )
)
def dq_model_tests(spark: Spark, sf: str) -> Frame:
    tested = [e.column for e in quality.MODEL_SUITES["fct_bookings"]]
    stored = gold_table(spark, sf, *tested, *DIMENSION_COLUMNS["customers"], *DIMENSION_COLUMNS["hotels"])
    return quality.run_model_tests(
        {
            "fct_bookings": models.fct_bookings(stored, tested),
            "dim_customers": models.dim_customers(stored),
            "dim_hotels": models.dim_hotels(stored),
        }
    )


@query(
    f"SELECT bool_and(success) AS passed, 'warn' AS reaction FROM ({_suite_sql(quality.SILVER_SUITE, 'silver')})"
)
def dq_gate(spark: Spark, sf: str) -> Frame:
    """The gate's decision beside what a failure leads to."""
    results = quality.run_suite(silver(spark, sf, *_DQ_COLUMNS), quality.SILVER_SUITE)
    stored = stage_table(results, "quality")
    passed = quality.gate(stored, "warn")
    return stored.agg(F.bool_and("success").alias("passed")).select(
        (F.col("passed") & F.lit(passed)).alias("passed"), F.lit("warn").alias("reaction")
    )


@query(
    """SELECT * FROM (SELECT 0 AS position, 'between' AS expectation, 'nights' AS "column", CAST(nights AS STRING) AS value, count(*) AS rows
         FROM raw WHERE CAST(nights AS INTEGER) < 2 OR CAST(nights AS INTEGER) > 40 GROUP BY nights)
       UNION ALL SELECT 1, 'unique', 'booking_id', booking_id, count(*) FROM raw GROUP BY booking_id HAVING count(*) > 1"""
)
def dq_unexpected_values(spark: Spark, sf: str) -> Frame:
    rows = raw(spark, sf, ["booking_id", "nights"]).withColumn("nights", F.col("nights").cast("int"))
    suite = [quality.expect_between("nights", 2, 40), quality.expect_unique("booking_id")]
    return quality.unexpected_values(rows, suite)


def _values_sql(suite, source: str) -> str:
    """Unexpected values by position, with their rows."""

    def one(i: int, e) -> str:
        value = f"SELECT {i} AS position, CAST({e.column} AS VARCHAR) AS value, count(*) AS rows FROM {source}"
        if e.kind == quality.UNIQUE:
            return f"{value} WHERE {e.column} IS NOT NULL GROUP BY {e.column} HAVING count(*) > 1"
        if e.kind == quality.NOT_NULL:
            return f"{value} WHERE {e.column} IS NULL GROUP BY {e.column}"
        tests = [f"{e.column} {sign} {v}" for sign, v in (("<", e.low), (">", e.high)) if v is not None]
        return f"{value} WHERE {' OR '.join(tests)} GROUP BY {e.column}"

    return " UNION ALL ".join(one(i, e) for i, e in enumerate(suite))


# The silver suite, and checks that the given bookings break in many ways.
_REPORT_SUITE = (
    *quality.SILVER_SUITE, quality.expect_unique("hotel_id"), quality.expect_not_null("total_rooms"),
    quality.expect_between("total_rooms", 25, 300),
)


@query(
    f"""SELECT s.*, round(avg(CAST(success AS INTEGER)) OVER () * 100, 6) AS success_percent, coalesce(n.n, 0) AS n_values
        FROM ({_suite_sql(quality.SILVER_SUITE, "silver")}) s
        LEFT JOIN (SELECT position, count(*) AS n FROM ({_values_sql(quality.SILVER_SUITE, "silver")}) GROUP BY position) n USING (position)"""
)
def dq_report_json(spark: Spark, sf: str) -> Frame:
    """The suite's report document, written as JSON and read back."""
    rows = stage_table(silver(spark, sf, *_DQ_COLUMNS), "checked")
    results = _checked(quality.run_suite(rows, quality.SILVER_SUITE))
    values = stage_table(quality.unexpected_values(rows, quality.SILVER_SUITE), "unexpected")
    written = reports.write_report(results, workspace(spark, "reports"), values)
    shape = (
        f"results array<{results.schema.simpleString()}>, statistics struct<success_percent:double>,"
        " unexpected_values array<struct<position:int,n_values:bigint>>"
    )
    read = written.select(F.from_json("value", shape).alias("d"))
    counted = F.filter("d.unexpected_values", lambda v: v["position"] == F.col("position"))
    return read.select("d", F.inline("d.results")).select(
        *results.columns,
        F.round("d.statistics.success_percent", 6).alias("success_percent"),
        F.coalesce(F.get(counted, F.lit(0))["n_values"], F.lit(0)).alias("n_values"),
    )


@query(
    f"""SELECT position, CAST(n AS BIGINT) AS n_values, value, rows
        FROM (SELECT *, count(*) OVER (PARTITION BY position) AS n FROM ({_values_sql(_REPORT_SUITE, "silver")}))"""
)
def dq_report_values(spark: Spark, sf: str) -> Frame:
    """All unexpected values behind a report document, through the run that the document names."""
    columns = list(dict.fromkeys([*_DQ_COLUMNS, *(e.column for e in _REPORT_SUITE)]))
    rows = stage_table(silver(spark, sf, *columns), "checked")
    results, folder = quality.run_suite(rows, _REPORT_SUITE), workspace(spark, "reports")
    written = reports.write_report(results, folder, quality.unexpected_values(rows, _REPORT_SUITE))
    shape = "run string, unexpected_values array<struct<position:int,n_values:bigint>>"
    named = written.select(F.from_json("value", shape).alias("d")).select("d.run", F.inline("d.unexpected_values"))
    return reports.report_values(spark, folder).join(named, ["run", "position"]).select("position", "n_values", "value", "rows")


# --- streaming --------------------------------------------------------------------------

_EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _event_folders(spark: Spark, label: str) -> tuple[str, str, str]:
    base = workspace(spark, label)
    return f"{base}/in", f"{base}/table", f"{base}/checkpoint"


def _as_timestamp(df: Frame) -> Frame:
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_EVENTS_TEXT_SQL = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"


@query(_EVENTS_TEXT_SQL)
def stream_land(spark: Spark, sf: str) -> Frame:
    """Events land as they are; a restart from the checkpoint adds nothing."""
    source, target, checkpoint = _event_folders(spark, "land")
    rows = B.table(spark, sf, "events")
    replay(rows, source)
    landing.land_stream(spark, source, target, checkpoint, rows.schema)
    return _as_timestamp(landing.land_stream(spark, source, target, checkpoint, rows.schema))


# Files of the waiting events; no batch is larger than the rule by more than one of them.
_WAITING_ROWS = 700


def _landed_by_rule(spark: Spark, rows: Frame, label: str) -> tuple[Frame, Frame]:
    """Landed events and whether all batches but the last keep the landing rule."""
    source, target, checkpoint = _event_folders(spark, label)
    queue_events(rows, source, _WAITING_ROWS)
    waiting = read_waiting(spark, source, f"{target}-log", ending=True)
    stream = landing.parse_events(waiting, rows.schema)
    landed = landing.land_batches(stream, target, checkpoint, {"processingTime": "0 seconds"}, until_idle=True)
    sizes = landed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.col("batch_id") < sizes.agg(F.max("batch_id")).scalar()
    small, large = F.col("n") < C.LANDING_MIN_ROWS, F.col("n") >= C.LANDING_MIN_ROWS + _WAITING_ROWS
    return landed, sizes.agg(~F.bool_or((earlier & small) | large)).scalar()


@query(
    """SELECT event_type, count(*) AS rows, round(sum(value), 2) AS value, true AS within_rule
       FROM events GROUP BY event_type"""
)
def stream_microbatch(spark: Spark, sf: str) -> Frame:
    """Events land in batches of 10 000 rows or more but for the last; together they are all events."""
    landed, within = _landed_by_rule(spark, B.table(spark, sf, "events"), "batches")
    return landed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("value")
    ).withColumn("within_rule", within)


@query(
    "SELECT booking_id, coalesce(booking_status, '') AS booking_status, true AS within_rule, true AS batches_fit FROM raw"
)
def stream_landing_rule(spark: Spark, sf: str) -> Frame:
    """Bookings under the landing rule: enough of them for many batches, each as large as it must be."""
    rows = raw(spark, sf, ["booking_id", "booking_status"])
    landed, within = _landed_by_rule(spark, rows, "rule")
    total, n = landed.agg(F.count(F.lit(1)), F.max("batch_id") + 1).first()
    fit = total // (C.LANDING_MIN_ROWS + _WAITING_ROWS) <= n <= total // C.LANDING_MIN_ROWS + 1
    return landed.select("booking_id", "booking_status").withColumns({"within_rule": within, "batches_fit": F.lit(fit)})


_REPLAY = list(B.BOOKING_COLUMNS)


@query("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _REPLAY) + " FROM raw")
def stream_replay(spark: Spark, sf: str) -> Frame:
    """Bookings replayed in as many lanes as keep the cores busy, each landed by a stream of its own."""
    source, target, checkpoint = _event_folders(spark, "replay")
    replay(raw(spark, sf, _REPLAY), source, lanes=max(1, spark.sparkContext.defaultParallelism // 2))
    return landing.land_lanes(spark, source, target, checkpoint, text_schema(_REPLAY), max_files=4)


@query(
    """SELECT CASE WHEN event_type = 'click' THEN NULL ELSE event_id END AS event_id,
         CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_type = 'purchase' THEN value END AS bonus, event_type = 'click' AS unreadable,
         CASE WHEN event_type = 'click' THEN '{"event_id":' || event_id || ',"event_type":"click"' ELSE '' END AS unreadable_text FROM events"""
)
def stream_schema_drift(spark: Spark, sf: str) -> Frame:
    """Events whose shape changes by type: one type is cut off, another has a new field."""
    source, target, checkpoint = _event_folders(spark, "drift")
    rows = B.table(spark, sf, "events")
    plain = F.to_json(F.struct("event_id", "event_type"))
    extended = F.to_json(F.struct("event_id", "event_type", F.col("value").alias("bonus")))
    kind = F.col("event_type")
    cut_off = F.left(plain, F.length(plain) - 1)
    lines = F.when(kind == "purchase", extended).when(kind == "click", cut_off).otherwise(plain)
    rows.select(lines.alias("value")).write.text(source)
    landed = landing.land_variants(spark, source, target, checkpoint)
    # No field is named: all come from the events.
    events = landing.typed_events(landed)
    return events.select(
        "event_id", "event_type", F.col("bonus").cast("double").alias("bonus"), F.col("unreadable").isNotNull().alias("unreadable"),
        F.coalesce("unreadable", F.lit("")).alias("unreadable_text"),
    )


@query("SELECT " + ", ".join(_REPLAY) + " FROM silver", raw=sql.STREAMED_RAW)
def stream_silver(spark: Spark, sf: str) -> Frame:
    """Silver bookings of a stored batch and a stream, places included, as if all were one batch.

    The stream is stopped after its first half and goes on from the checkpoint.
    """
    rows = stage_table(raw(spark, sf, _REPLAY, keep=["k"]), "raw")
    batch, stream = sets.split_batch_stream(rows, in_batch=B.in_batch())
    source, folder, checkpoint = _event_folders(spark, "silver")
    known = lookups(spark, sf)
    cleaned = stage_table(places.without_hotel_places(batch.select(_REPLAY), known, B.LAST_YEAR), "batch-cleaned")
    places.start_places(cleaned, folder)
    for half in (F.col("k") % 2 == 0, F.col("k") % 2 == 1):
        replay(stream.filter(half).select(_REPLAY), source)
        events = landing.read_events(spark, source, text_schema(_REPLAY), max_files=6)
        places.land_bookings(events, folder, checkpoint, known, B.LAST_YEAR)
    return places.silver_of(spark, cleaned, folder, known)


# --- jobs -------------------------------------------------------------------------------


@query(
    """SELECT weather_date, city_name, temp_max, rain_sum FROM weather WHERE city_name IN (SELECT city FROM raw)"""
)
def backfill_gaps(spark: Spark, sf: str) -> Frame:
    """Weather for the cities of the bookings in rounds: some never asked for, some answers cut off.

    The second round asks for what has no rows, failed answers included; a third adds nothing.
    """
    want = stage_table(raw(spark, sf, ["city"]).filter("city IS NOT NULL").distinct(), "want")
    _, answers = _answers(B.daily_rates(spark, sf), B.daily_weather(spark, sf))
    answers = stage_table(answers, "answers")
    cut_off = F.col("city").like("%1")
    payload = F.when(cut_off, F.left("payload", F.length("payload") - 1)).otherwise(F.col("payload"))
    given = answers.filter(F.col("city") < "CITY 2").withColumn("payload", payload)
    name, path = _name("weather"), workspace(spark, "weather")
    table = load_weather(given, want, name, path)
    failed = stage_table(payloads.weather_failures(given, "city", "payload"), "failed")
    for _ in range(2):
        asked = stage_table(backfill.to_ask(want, table, failed, {"city": "city_name"}, "city"), "asked")
        table = load_weather(answers.join(asked, "city", "left_semi"), want, name, path)
    return table


_FAILED = """CASE WHEN k % 11 = 0 THEN 'missing' WHEN k % 5 = 0 THEN 'not json' WHEN k % 7 = 0 THEN 'no data'
  WHEN k % 13 = 0 THEN 'no rows' END"""


@query(
    f"SELECT booking_id, reason FROM (SELECT booking_id, {_FAILED} AS reason FROM raw) WHERE reason IS NOT NULL"
)
def failed_answers(spark: Spark, sf: str) -> Frame:
    """Forecast answers of bookings that gave no rows: none came, cut off, an error, or without days."""
    day = F.col("l_shipdate").cast("date").cast("string")
    days = F.when(F.col("k") % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(day))
    daily = F.struct(days.alias("time"), F.array(F.lit(1.5)).alias("temperature_2m_max"), F.array(F.lit(0.0)).alias("rain_sum"))
    whole = F.to_json(F.struct(daily.alias("daily")))
    payload = (
        F.when(F.col("k") % 11 == 0, F.lit(None).cast("string"))
        .when(F.col("k") % 5 == 0, F.left(whole, F.length(whole) - 1))
        .when(F.col("k") % 7 == 0, F.lit('{"error":true,"reason":"limit"}'))
        .otherwise(whole)
    )
    answers = raw(spark, sf, ["booking_id"], keep=["k", "l_shipdate"]).select("booking_id", payload.alias("payload"))
    return payloads.weather_failures(answers, "booking_id", "payload").select("booking_id", "reason")


_CURRENCY = "booking_id, country_name, currency_code_map, round(effective_rate, 6) AS effective_rate, " + _USD


@query(f"SELECT {_CURRENCY} FROM priced")
def currency_enrich(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "booking_id", "country", "booking_date", "total_price")
    rows = enrich.enrich_currency(rows, stage_table(B.daily_rates(spark, sf), "rates")).select(
        "booking_id", "country_name", "currency_code_map", "effective_rate", "total_price_usd"
    )
    return rounded(rows, effective_rate=6, total_price_usd=6)


@query(
    "SELECT booking_id, city, checkin_date, temp_max, rain_sum, is_rainy, "
    + sql.BAND.replace("total_price_usd", "total_price") + " AS price_category FROM gold"
)
def weather_enrich(spark: Spark, sf: str) -> Frame:
    rows = silver(spark, sf, "booking_id", "city", "checkin_date", "total_price").withColumnRenamed(
        "total_price", "total_price_usd"
    )
    return enrich.enrich_weather(rows, stage_table(B.daily_weather(spark, sf), "weather")).select(
        "booking_id", "city", "checkin_date", "temp_max", "rain_sum", "is_rainy", "price_category"
    )


_LETTERED = f"""SELECT w.*, row_number() OVER (PARTITION BY {sql.letters('city_name')}, weather_date ORDER BY temp_max, rain_sum) AS rn,
  {sql.letters('city_name')} AS lettered FROM weather w"""


@query(
    f"""SELECT s.booking_id, s.city, s.checkin_date, coalesce(w.temp_max, 22.5e0) AS temp_max, coalesce(w.rain_sum, 0.0e0) AS rain_sum
        FROM silver s LEFT JOIN (SELECT * FROM ({_LETTERED}) WHERE rn = 1) w
          ON {sql.letters('s.city')} = w.lettered AND s.checkin_date = w.weather_date"""
)
def weather_enrich_letters(spark: Spark, sf: str) -> Frame:
    """Weather by letters-only city names, of which several cities share one."""
    rows = silver(spark, sf, "booking_id", "city", "checkin_date", "total_price").withColumnRenamed(
        "total_price", "total_price_usd"
    )
    weather = stage_table(B.daily_weather(spark, sf), "weather")
    return enrich.enrich_weather(rows, weather, "letters").select(
        "booking_id", "city", "checkin_date", "temp_max", "rain_sum"
    )


@query("SELECT * EXCLUDE (k) FROM silver")
def silver_job(spark: Spark, sf: str) -> Frame:
    return silver(spark, sf)


@query(f"SELECT * EXCLUDE (k) REPLACE (round(effective_rate, 6) AS effective_rate, {_USD}) FROM gold")
def gold_job(spark: Spark, sf: str) -> Frame:
    return rounded(gold(spark, sf), effective_rate=6, total_price_usd=6)


def _answers(rates: Frame, weather: Frame) -> tuple[Frame, Frame]:
    """The services' answers as they come: rates by year, weather by city, as JSON text."""
    day = F.col("rate_date").cast("string")
    days = rates.groupBy("rate_date").agg(
        F.map_from_entries(F.collect_list(F.struct("currency_code", "usd_rate"))).alias("_codes")
    )
    years = days.groupBy(F.year("rate_date")).agg(
        F.map_from_entries(F.collect_list(F.struct(day, "_codes"))).alias("rates")
    )
    rate_answers = years.select(F.to_json(F.struct("rates")).alias("payload"))
    row = F.struct(F.col("weather_date").cast("string").alias("time"), F.col("temp_max"), "rain_sum")
    cities = weather.groupBy(F.col("city_name").alias("city")).agg(F.sort_array(F.collect_list(row)).alias("_d"))
    daily = F.struct(
        F.col("_d.time").alias("time"), F.col("_d.temp_max").alias("temperature_2m_max"), F.col("_d.rain_sum").alias("rain_sum")
    )
    return rate_answers, cities.select("city", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))


@query(f"SELECT * EXCLUDE (k) REPLACE (round(effective_rate, 6) AS effective_rate, {_USD}) FROM gold")
def gold_by_day(spark: Spark, sf: str) -> Frame:
    """Gold kept by booking day: first with other prices on the days of one month, then refreshed for these days."""
    rows = stage_table(raw(spark, sf), "raw")
    none, known, folder = rows.limit(0), lookups(spark, sf), workspace(spark, "days")
    rates, weather = reference(spark, sf)
    day = increments.booking_day(rows, B.LAST_YEAR)
    price = F.when(F.month(day) == 5, F.lit("1.5")).otherwise(F.col("total_price"))
    for version in (rows.withColumn("total_price", price), rows):
        silver_days = increments.silver_by_day(version, none, known, f"{folder}/silver", B.LAST_YEAR)
        gold_days = increments.gold_by_day(silver_days, rates, weather, f"{folder}/gold")
    return rounded(gold_days.rows, effective_rate=6, total_price_usd=6)


def _flow(spark: Spark, sf: str, folder: str, suffix: str):
    """CSV batch, JSON stream and the services' answers to the star."""
    columns = list(B.BOOKING_COLUMNS)
    landed = stage_table(raw(spark, sf, columns, keep=["k"]), "arrivals")
    batch_rows, stream_rows = (
        part.select(columns) for part in sets.split_batch_stream(landed, in_batch=B.in_batch())
    )
    files.write_raw_csv(batch_rows, f"{folder}/csv")
    batch = files.with_provenance(files.read_raw_csv(spark, f"{folder}/csv", text_schema(columns)))
    batch = tables.materialize(batch, _name("bronze_batch"), f"{folder}/bronze_batch")
    replay(stream_rows, f"{folder}/json")
    stream = landing.land_stream(
        spark, f"{folder}/json", f"{folder}/bronze_stream", f"{folder}/checkpoint", text_schema(columns)
    )
    answers = _answers(B.daily_rates(spark, sf), B.daily_weather(spark, sf))
    return run_all(spark, batch, stream, lookups(spark, sf), *answers, folder, suffix, B.LAST_YEAR)


@query(_BY_CITY.replace("SELECT h.city,", "SELECT h.city, count(booking_id) AS total_bookings,") + " GROUP BY h.city",
       raw=sql.TRAVELLED_RAW, rates=sql.ALL_RATES)
def end_to_end(spark: Spark, sf: str) -> Frame:
    """The whole flow, then bookings and revenue by city."""
    done = _flow(spark, sf, workspace(spark, "flow"), "_" + uuid.uuid4().hex)
    wanted = [m.total_bookings(), m.total_revenue()]
    by_city = m.evaluate(done.star, ["hotels.city"], wanted).withColumnRenamed("hotels_city", "city")
    return rounded(by_city, total_revenue=0)


@query(f"SELECT {_CURRENCY} FROM priced", rates=sql.ALL_RATES)
def gold_with_flat_rates(spark: Spark, sf: str) -> Frame:
    """Prices by rates loaded twice from the services' answers, flat rates included."""
    name, path = _name("exchange_rates"), workspace(spark, "exchange_rates")
    answers, _ = _answers(B.daily_rates(spark, sf), B.daily_weather(spark, sf))
    load_rates(answers, name, path)
    rates = load_rates(answers, name, path)
    rows = silver(spark, sf, "booking_id", "country", "booking_date", "total_price")
    rows = enrich.enrich_currency(rows, rates).select(
        "booking_id", "country_name", "currency_code_map", "effective_rate", "total_price_usd"
    )
    return rounded(rows, effective_rate=6, total_price_usd=6)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
