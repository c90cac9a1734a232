"""Language of web pages by Bayesian fusion of four kinds of evidence.

Text: letter three-grams of the visible text under a model per language, trained on
documents of known language. Markup: the language the page declares. Address: the suffix of
its host, and a two-letter first part of its path. Host: how often pages of the same host
are in each language, smoothed towards the host's domain, and that towards all pages.

How far declared languages and suffixes can be trusted, and the hosts' shares, come from
grouped sums of the pages' text posteriors; a page's own share is taken out of its host's,
so that no evidence counts twice. The posterior is the product of the host prior and the
three likelihoods, brought to sum 1.

Training takes at most ``SAMPLE_ROWS`` documents of each language, by a hash of the id. All
sums are over all pages. Languages are the few of the training table.

Defined results: a missing address has no host and the prior of all pages; missing or empty
text, or no declared language, adds no evidence; equal rows each count. Without training
documents there are no languages and no rows with one: ``lang`` is missing.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common
from stayledger.storage import stage_table

SAMPLE_ROWS = 400
GRAM_BITS = 16
# Neighbouring three-grams repeat each other's evidence: so many letters count as one.
TEMPER = 8.0
GRAM_PRIOR, EVIDENCE_PRIOR, HOST_PRIOR = 0.5, 1.0, 5.0

_HIDDEN = re.compile(r"(?is)<(script|style|nav|noscript)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"<[^>]*>")
_DECLARED = r"""(?i)<html[^>]*\slang\s*=\s*["']?([a-z]{2})"""
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[/?#]|$)"


def visible(page: str) -> str:
    return markup.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def grams(text: str) -> np.ndarray:
    """Hashed three-grams of lower-cased letters, with one blank for everything between words."""
    letters = " ".join(re.findall(r"[^\W\d_]+", text.lower()))
    code = np.frombuffer(f" {letters} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(code) < 3:
        return np.zeros(0, np.int64)
    key = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1]) * np.uint64(0x85EBCA77) + code[2:]
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of the three-grams in each."""
    known = docs.select("doc_id", "lang").where("lang is not null and doc_id is not null")
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    draw = F.xxhash64(F.lit(19), "doc_id")
    sample = None
    for name in names:
        part = known.where(F.col("lang") == name).orderBy(draw, "doc_id").limit(sample_rows)
        sample = part if sample is None else sample.unionByName(part)
    table = np.full((len(names), 1 << GRAM_BITS), GRAM_PRIOR)
    if not names:
        return names, table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(names), 1 << GRAM_BITS), np.int64)
        for whole in batches:
            for batch in common.chunks(whole, "text"):
                for name, text in zip(batch.column("lang").to_pylist(), common.texts(batch)):
                    seen[names.index(name)] += np.bincount(grams(text), minlength=1 << GRAM_BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen.ravel()[at])], ["at", "n"])

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("lang", "text")
    # At most one row per language and three-gram number.
    for r in texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        table.ravel()[r["at"]] += r["n"]
    return names, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def text_evidence(pages: DataFrame, names: list[str], table: np.ndarray, html: str = "html") -> DataFrame:
    """Pages without their html, with the tempered log likelihood of each language."""
    keep = [c for c in pages.columns if c != html]
    shared = pages.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, html):
                rows = [
                    (shared.value[:, grams(visible(page))].sum(1, dtype=float) / TEMPER).tolist()
                    for page in common.texts(batch, html)
                ]
                yield common.append(batch.select(keep), [pa.array(rows, pa.list_(pa.float64()))], ["text_log"])

    return pages.mapInArrow(run, common.added(pages.select(*keep), "text_log array<double>"))


def _softmax(log):
    top = F.array_max(log)
    weights = F.transform(log, lambda x: F.exp(x - top))
    return F.transform(weights, lambda x: x / F.aggregate(weights, F.lit(0.0), lambda a, y: a + y))


def identify(
    pages: DataFrame, docs: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per page: ``lang``, its ``probability``, and what the evidence was."""
    names, table = train(docs)
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.lower(F.nullif(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1), F.lit(""))).alias("host"),
        F.nullif(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PATH, 1), F.lit("")).alias("path_lang"),
        F.lower(F.nullif(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), _DECLARED, 1), F.lit(""))).alias("declared"),
        F.col(html).alias("html"),
    )
    if not names:
        empty = [F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"))]
        return rows.select("page_id", *empty, "declared", "host")
    parts = F.split("host", r"\.")
    domain = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.col("host"))
    suffix = F.concat_ws("/", F.element_at(parts, -1), "path_lang")
    measured = text_evidence(
        rows.withColumn("domain", domain).withColumn("suffix", F.nullif(suffix, F.lit(""))), names, table
    )
    measured = stage_table(measured.withColumn("text_post", _softmax(F.col("text_log"))), "page-evidence")
    each = [F.sum(F.get("text_post", F.lit(i))).alias(f"s{i}") for i in range(len(names))]
    sums = lambda key: measured.where(F.col(key).isNotNull()).groupBy(key).agg(*each)
    vector = lambda alias: F.array(*[F.col(f"s{i}") for i in range(len(names))]).alias(alias)
    overall = measured.agg(*each).first()
    total = np.array([x or 0.0 for x in overall])
    everyone = (total + 1) / (total.sum() + len(names))
    prior = F.array(*[F.lit(float(x)) for x in everyone])
    out = measured
    for key in ("declared", "suffix", "domain", "host"):
        out = out.join(sums(key).select(key, vector(f"{key}_sums")), key, "left")

    def likelihood(column: str, kinds: int):
        """log P(evidence | language), from sums without the page's own share."""
        own = F.zip_with(column, "text_post", lambda s, p: F.greatest(s - p, F.lit(0.0)))
        of = F.transform(own, lambda s, i: F.log((s + EVIDENCE_PRIOR) / (F.get(F.array(*[F.lit(float(x)) for x in total]), i) + EVIDENCE_PRIOR * kinds)))
        return F.coalesce(of, F.array(*[F.lit(0.0)] * len(names)))

    def smoothed(column: str, towards):
        own = F.coalesce(F.zip_with(column, "text_post", lambda s, p: F.greatest(s - p, F.lit(0.0))), F.array(*[F.lit(0.0)] * len(names)))
        n = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, towards, lambda s, p: (s + HOST_PRIOR * p) / (n + HOST_PRIOR))

    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    log = plus(
        plus(F.transform("host_prior", lambda p: F.log(p)), F.col("text_log")),
        plus(likelihood("declared_sums", 4), likelihood("suffix_sums", 16)),
    )
    fused = (
        out.withColumn("domain_prior", smoothed("domain_sums", prior))
        .withColumn("host_prior", smoothed("host_sums", F.col("domain_prior")))
        .withColumn("posterior", _softmax(log))
    )
    best = lambda column: F.get(F.array(*[F.lit(x) for x in names]), (F.array_position(column, F.array_max(column)) - 1).cast("int"))
    return fused.select(
        "page_id", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"),
        best(F.col("text_post")).alias("text_lang"), "declared", "host",
    )
