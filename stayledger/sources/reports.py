"""Quality reports as JSON documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A document shows so many values of each expectation, unless its writer says otherwise.
LISTED = 20


def report_document(
    results: DataFrame, values: DataFrame | None = None, run: str = "", listed: int = LISTED
) -> DataFrame:
    """One suite run as a single stamped JSON document: success, statistics, result rows.

    A suite has one row per expectation. ``values`` are its unexpected values; a document
    is one task's row and no place for all of them, so it holds their number and the
    ``listed`` most frequent ones of each expectation, and names the run under which
    ``write_report`` stores all.
    """
    fields = F.struct(*results.columns)
    passed = F.count(F.when(F.col("success"), 1))
    total = F.count(F.lit(1))
    statistics = F.struct(
        total.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (total - passed).alias("unsuccessful_expectations"),
        F.try_divide(passed * 100.0, total).alias("success_percent"),
    )
    document = results.agg(
        F.sort_array(F.collect_list(fields)).alias("results"), statistics.alias("statistics"),
        (passed == total).alias("success"), F.lit(0).alias("_run"),
    )
    parts = ["success", "statistics", "results"]
    if values is not None:
        document = document.join(_top_values(values, listed).withColumn("_run", F.lit(0)), "_run", "left")
        parts.append("unexpected_values")
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("run_time")
    return document.select(F.to_json(F.struct(stamp, F.lit(run).alias("run"), *parts)).alias("value"))


def _top_values(values: DataFrame, listed: int) -> DataFrame:
    """One row with the most frequent values of each expectation, and how many there are."""
    counts = values.groupBy("position", "expectation", "column").agg(F.count(F.lit(1)).alias("n_values"))
    # Tasks keep no more than the first ranks before they send values on.
    frequent = Window.partitionBy("position").orderBy(F.desc("rows"), F.asc_nulls_first("value"))
    ranked = values.withColumn("_rank", F.row_number().over(frequent)).filter(F.col("_rank") <= listed)
    rows = F.sort_array(F.collect_list(F.struct("_rank", "value", "rows")))
    tops = ranked.groupBy("position").agg(
        F.transform(rows, lambda r: F.struct(r["value"].alias("value"), r["rows"].alias("rows"))).alias("values")
    )
    each = F.struct("position", "expectation", "column", "n_values", "values")
    return counts.join(tops, "position", "left").agg(F.sort_array(F.collect_list(each)).alias("unexpected_values"))


def values_folder(folder: str) -> str:
    """Where the values of a folder of reports are."""
    return f"{folder}_values"


def write_report(
    results: DataFrame,
    folder: str,
    values: DataFrame | None = None,
    limit: int | None = None,
    listed: int = LISTED,
) -> DataFrame:
    """Add a report file to the folder; earlier reports stay.

    The unexpected values are stored beside it, all of them or the ``limit`` most frequent of
    each expectation, before the document that names their run is written.
    """
    run = uuid.uuid4().hex
    if values is not None:
        if limit is not None:
            frequent = Window.partitionBy("position").orderBy(F.desc("rows"), F.asc_nulls_first("value"))
            values = values.withColumn("_rank", F.row_number().over(frequent)).filter(F.col("_rank") <= limit).drop("_rank")
        values.write.parquet(f"{values_folder(folder)}/run={run}")
        values = results.sparkSession.read.schema(values.schema).parquet(f"{values_folder(folder)}/run={run}")
    report_document(results, values, run, listed).coalesce(1).write.mode("append").text(folder)
    return results.sparkSession.read.text(folder)


def report_values(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame:
    """Stored unexpected values of all reports of a folder, or of one run."""
    values = spark.read.parquet(values_folder(folder)).withColumn("run", F.col("run").cast("string"))
    return values if run is None else values.filter(F.col("run") == run)
