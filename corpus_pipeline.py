"""A training corpus from documents: five stages, each on all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again
as the next one's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import decontaminate, near_dup, packing, secrets, toxicity
from stayledger.llm.common import remainder, table, whole_rows
from stayledger.storage import stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not reject."""
    labels = table(spark, sf_dir, "labels").where(remainder(5) != 0)
    model = toxicity.train(docs, labels)
    scored = toxicity.score(whole_rows(docs, "text"), model)
    return scored.where("predicted = 0").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Rows are judged each by its own text, also those that repeat an id. Of rows with one id
    and one set of shingles the one with the least text stays; rows without words are
    copies only if their texts are equal.
    """
    label = near_dup.LABEL
    found = near_dup.judged(docs).where("kept and doc_id is not null").select("doc_id", "body", *label).distinct()
    rows = whole_rows(docs, "doc_id", "text").withColumn("body", F.xxhash64("text"))
    kept = rows.join(found, ["doc_id", "body"])
    wordless = F.when(F.col("n_shingles") == 0, F.col("body")).alias("wordless")
    once = kept.groupBy("doc_id", *label, wordless).agg(F.min_by("_row", F.coalesce("text", F.lit(""))).alias("_row"))
    return once.select("_row.*").unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.find_benchmark_text(whole_rows(docs, "text"), benchmark)
    return found.where("n_hit = 0").select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets masked in the text and its length put right."""
    scanned = secrets.find_secrets(whole_rows(docs, "text"))
    row = lambda name: F.col(f"_row.`{name}`")
    changed = {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("redacted").cast(kind)
        changed["n_chars"] = F.when(F.size("secrets") > 0, length).otherwise(row("n_chars"))
    return scanned.select(*[changed.get(c, row(c)).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of token ids in sequences."""
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# Trained models and token ids are beyond SQL; a test holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
