"""Awkward documents that every operator must take."""

import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = "The quick brown fox jumps over the lazy dog, and then it rests for a while by the river."
LONG = " ".join(f"word{i % 977}" for i in range(30000))
TEXTS = [
    PROSE,
    PROSE,
    None,
    "",
    " \n\t\x0b ",
    "x",
    "One two three.",
    PROSE.upper(),
    PROSE + " Nothing else happened that day.",
    LONG,
    LONG + " end",
    "a" * 5000,
    "Ünïcode wörds — « naïve » 你好 世界 🙂 \x00 odd",
    'see token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here',
    "line\nline\nline\n\nother\nline",
    "you are stupid. s t u p i d and stxupid",
    "<|endoftext|> is text",
]
# Names that operators use for results.
CLASHING = (
    "score predicted worth margin shard slot law kept component_id n_words n_hit items hit_spans start length"
    " ids offset sequence_id n_candidates secrets redacted base model word times posterior base_failed _w"
).split()


def documents(spark, texts=TEXTS, repeat=True, extra=True):
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    if repeat:
        rows += [rows[0], (None, PROSE, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in CLASHING:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("mine"))
    return df


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(zip(*[w[i:] for i in range(5)]))
    return frozenset([tuple(w)]) if w else frozenset()


def roots(sets, percent=75):
    """Smallest reachable id by comparing every pair."""
    at = {k: k for k in sets}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    at[y] = x
    return {k: find(k) for k in ids}
