"""Session settings the jobs profit from; set by programs, never by readers."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM leaves methods above 8000 bytes of bytecode uncompiled. A stage that cleans
# dozens of columns generates such a method; below this limit Spark splits it up instead.
COMPILED_METHOD_BYTES = 8000


def tune(spark: SparkSession) -> SparkSession:
    """Settings for wide cleaning stages, for a program that owns its session."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_METHOD_BYTES))
    return spark
