"""Quality rules as weak supervision, in DataFrame functions alone.

Each rule looks at one signal of a document and votes good (1), bad (-1) or abstains (0).
Rules err at different rates, so that not all of them must pass: expectation-maximisation
over the counts of vote patterns estimates how often a rule votes each way on good and on
bad documents, without labels, and a document's posterior probability of being good is
the verdict. Patterns number at most 3 to the power of the rules, whatever the input.

Defined results: a missing text has no words; a document without words fails the base
rule; with no documents there is nothing to estimate and nothing is returned. Columns of
the documents go through, but for those named like a result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Name, numerator, denominator, and bounds in per cent: good up to the first (None: never votes
# good), bad above the second, no vote between.
RULES = (
    ("symbols", "n_symbols", "n_words", None, 30),
    ("capitals", "n_capitals", "word_chars", None, 30),
    ("shouting", "n_exclaim", "n_words", None, 10),
    ("tables", "n_bars", "n_words", None, 15),
    ("repeated_words", "n_repeat_words", "n_words", None, 30),
    ("repeated_lines", "n_dup_lines", "n_lines", None, 30),
    ("long_words", "word_chars", "n_words", 900, 1300),
    ("open_lines", "n_open_lines", "n_lines", 35, 75),
)
ROUNDS = 20
# Assumed before the first round: how often a rule votes each way on good and on bad documents.
# A bad vote is rare on good documents; a bad document trips some rules, not all.
START_GOOD = 0.8
START = {1: {1: 0.7, 0: 0.29, -1: 0.01}, 0: {1: 0.4, 0: 0.3, -1: 0.3}}
# Votes added to each count, so that no probability becomes 0 or 1.
SMOOTH = 1.0

SIGNALS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_capitals n_exclaim n_bars"
    " n_lines n_open_lines"
).split()
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def word_list(text: Column) -> Column:
    body = F.btrim(text, F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANK_RUN))


def repeated_window_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are sorted by a 32-bit hash with their position; only those that share a hash
    are compared by their words.
    """

    def numbered(w: Column) -> Column:
        code = lambda x, i: F.shiftleft(F.hash(x, F.get(w, i + 1), F.get(w, i + 2)).cast("long"), 32).bitwiseOR(i.cast("long"))
        last = F.greatest(F.size(w) - 2, F.lit(0))
        return F.sort_array(F.slice(F.transform(w, code), F.lit(1), last))

    def alike(s: Column) -> Column:
        high = lambda j: F.shiftright(F.get(s, j), 32)
        return F.filter(
            s, lambda v, j: (F.shiftright(v, 32) == high(j - 1)) | (F.shiftright(v, 32) == high(j + 1))
        )

    def windows(w: Column, codes: Column) -> Column:
        def window(v: Column) -> Column:
            i = v.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
            return F.struct(
                F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")
            )

        return F.sort_array(F.transform(codes, window))

    def equal(s: Column) -> Column:
        same = lambda v, j: F.get(s, j).getField("g") == v.getField("g")
        return F.sort_array(
            F.transform(F.filter(s, lambda v, j: same(v, j - 1) | same(v, j + 1)), lambda v: v.getField("i"))
        )

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def of(w: Column) -> Column:
        return let(
            let(numbered(w), alike),
            lambda codes: let(let(windows(w, codes), equal), covered),
        )

    return of(words)


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts that rules look at, over whole texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words"))

    def of_lines(s: Column) -> Column:
        closed = F.filter(s, lambda x: F.rtrim(x).rlike(r"[.!?]$"))
        n = F.size(s).cast("long")
        return F.struct(
            n.alias("n_lines"),
            (n - F.size(F.array_distinct(s))).alias("n_dup_lines"),
            (n - F.size(closed)).alias("n_open_lines"),
        )

    out = docs.select(
        *[f"`{c}`" for c in common.carried(docs, [*SIGNALS, "_w", "_l"])],
        let(word_list(body), of_words).alias("_w"),
        let(lines, of_lines).alias("_l"),
        F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
        count_of(body, SYMBOLS).alias("n_symbols"),
        count_of(body, CAPITALS).alias("n_capitals"),
        count_of(body, "!").alias("n_exclaim"),
        count_of(body, "|").alias("n_bars"),
    )
    return out.select("*", "_w.*", "_l.*").drop("_w", "_l")


def votes(measured: DataFrame) -> list[Column]:
    """One vote per rule: 1 good, -1 bad, 0 none. Nothing to divide by: no vote."""
    out = []
    for name, part, whole, good, bad in RULES:
        share, of = F.col(part) * 100, F.col(whole)
        vote = F.when(of == 0, 0).when(share > of * bad, -1)
        vote = vote if good is None else vote.when(share <= of * good, 1)
        out.append(vote.otherwise(0).cast("int").alias(f"vote_{name}"))
    return out


def log_odds(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """Prior log odds of good, and each rule's log odds by vote, from counted vote patterns."""
    rules = len(patterns[0][0]) if patterns else 0
    prior = math.log(START_GOOD / (1 - START_GOOD))
    weights = [{v: math.log(START[1][v] / START[0][v]) for v in (1, 0, -1)} for _ in range(rules)]
    for _ in range(rounds):
        good = bad = 0.0
        tally = [{v: [0.0, 0.0] for v in (1, 0, -1)} for _ in range(rules)]
        for pattern, n in patterns:
            p = 1 / (1 + math.exp(-prior - sum(weights[r][v] for r, v in enumerate(pattern))))
            good, bad = good + n * p, bad + n * (1 - p)
            for r, v in enumerate(pattern):
                tally[r][v][0] += n * p
                tally[r][v][1] += n * (1 - p)
        prior = math.log((good + SMOOTH) / (bad + SMOOTH))
        weights = []
        for t in tally:
            odds = {
                v: math.log((t[v][0] + SMOOTH) / (good + 3 * SMOOTH))
                - math.log((t[v][1] + SMOOTH) / (bad + 3 * SMOOTH))
                for v in t
            }
            # No rule is taken to be worse than chance.
            weights.append({1: max(0.0, odds[1]), 0: odds[0], -1: min(0.0, odds[-1])})
    return prior, weights


def judge(measured: DataFrame) -> DataFrame:
    """Measured documents with votes, ``posterior``, ``base_failed`` and ``kept``.

    The signals are read twice, to estimate and to judge, so they should be stored.
    """
    names = [f"vote_{r[0]}" for r in RULES]
    keep = common.carried(measured, [*names, "posterior", "base_failed", "kept"])
    voted = measured.select(*[f"`{c}`" for c in keep], *votes(measured))
    counted = voted.groupBy(*names).count().collect()
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in counted)
    prior, weights = log_odds(patterns)
    total = F.lit(prior)
    for name, weight in zip(names, weights or [{1: 0.0, 0: 0.0, -1: 0.0}] * len(names)):
        v = F.col(name)
        total = total + F.when(v == 1, weight[1]).when(v == 0, weight[0]).otherwise(weight[-1])
    failed = (F.col("n_words") < BASE_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_REPEAT_PERCENT
    )
    scored = voted.withColumn("posterior", 1 / (1 + F.exp(-total))).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def oracle() -> str:
    """The same in DuckDB SQL: signals, votes, each round of estimation, and the verdict."""
    names = [f"v_{r[0]}" for r in RULES]
    votes_sql = ", ".join(
        f"CASE WHEN {whole} = 0 THEN 0 WHEN {part} * 100 > {whole} * {bad} THEN -1 "
        + (f"WHEN {part} * 100 <= {whole} * {good} THEN 1 " if good is not None else "")
        + f"ELSE 0 END AS v_{name}"
        for name, part, whole, good, bad in RULES
    )
    odds = lambda at, v, r: f"({at}.{r}_{'g' if v == 1 else 'b' if v == -1 else 'a'})"
    logit = lambda at: f"{at}.prior + " + " + ".join(
        f"CASE {n} WHEN 1 THEN {odds(at, 1, n)} WHEN 0 THEN {odds(at, 0, n)} ELSE {odds(at, -1, n)} END" for n in names
    )
    start = ", ".join(
        f"ln(CAST({START[1][v]} AS DOUBLE) / {START[0][v]}) AS {n}_{c}" for n in names for v, c in ((1, "g"), (0, "a"), (-1, "b"))
    )
    steps = [f"q0 AS (SELECT ln(CAST({START_GOOD} AS DOUBLE) / (1 - {START_GOOD})) AS prior, {start})"]
    for t in range(ROUNDS):
        rate = lambda n, v, y: f"ln((coalesce(sum(CASE WHEN {n} = {v} THEN {y} END), 0) + {SMOOTH}) / (sum({y}) + {3 * SMOOTH}))"
        parts = []
        for n in names:
            for v, c in ((1, "g"), (0, "a"), (-1, "b")):
                w = f"{rate(n, v, 'y')} - {rate(n, v, 'z')}"
                w = f"greatest(0.0, {w})" if v == 1 else f"least(0.0, {w})" if v == -1 else w
                parts.append(f"{w} AS {n}_{c}")
        steps.append(
            f"e{t} AS MATERIALIZED (SELECT {', '.join(names)}, n / (1 + exp(-({logit(f'q{t}')}))) AS y, "
            f"n - n / (1 + exp(-({logit(f'q{t}')}))) AS z FROM patterns, q{t})"
        )
        steps.append(
            f"q{t + 1} AS MATERIALIZED (SELECT ln((sum(y) + {SMOOTH}) / (sum(z) + {SMOOTH})) AS prior, {', '.join(parts)} FROM e{t})"
        )
    blank, escaped = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    count = lambda chars: f"length(body) - length(translate(body, '{chars}', ''))"
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS body,
         list_filter(string_split_regex(coalesce(text, ''), '{blank}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{escaped}')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, i, list_slice(w, i, i + 2) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
s AS (
  SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
         CAST({count(SYMBOLS)} AS BIGINT) AS n_symbols,
         CAST({count(CAPITALS)} AS BIGINT) AS n_capitals,
         CAST({count("!")} AS BIGINT) AS n_exclaim,
         CAST({count("|")} AS BIGINT) AS n_bars,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(l, lambda x: NOT regexp_matches(rtrim(x, ' '), '[.!?]$'))) AS BIGINT) AS n_open_lines,
         coalesce(a.n, 0) AS n_repeat_words
  FROM base b LEFT JOIN again a USING (doc_id)),
voted AS (SELECT *, {votes_sql} FROM s),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL),
{(","+chr(10)).join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words)
         AND 1 / (1 + exp(-({logit(f"q{ROUNDS}")}))) >= 0.5 AS kept
FROM voted, q{ROUNDS}
"""
