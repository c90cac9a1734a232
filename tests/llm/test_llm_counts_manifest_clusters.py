"""Token counts, Merkle manifests and Ptolemaic clustering against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import PROSE, TEXTS, documents

from pyspark.sql import functions as F

from stayledger.llm import merkle, packing, ptolemaic, token_counts

SF = "/root/testdata/sf0.001"


# Token counts


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(None, token_counts.unsettled())


PIECES = [
    "a", "b", "the", "ing", " ", "  ", "\n", "\n\n", "\t", "'s", "'re", "'", "'l", "1", "23", "!", "...", "é", "你好", "🙂",
    " ", "　", "<|endoftext|>", "<|end", "|>", "aaaa", "zzzz", "\x1c", "\x85", "‍", "é", "\U0001df2b", "ÃÂ",
]


def test_every_prefix_equals_the_library(library, counter):
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(14)))
        want = [library(text[:i]) for i in range(1, len(text) + 1)]
        assert counter.prefixes(text).tolist() == want
        assert counter.count(text) == (want[-1] if want else 0)


def test_given_texts_equal_the_library(spark, library, counter):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert all(counter.count(r["text"] or "") == library(r["text"] or "") for r in rows)


def test_merges_come_after_their_parts(counter):
    assert all(max(a, b) < whole for whole, (a, b, _) in counter.vocabulary.parts.items())


def test_stretches_change_nothing(monkeypatch, library, counter):
    monkeypatch.setattr(token_counts, "STRETCH", 50)
    text = "Some words,  and\n\n more — of them. " * 20
    assert counter.prefixes(text).tolist()[-1] == counter.count(text) == library(text)
    assert counter.prefixes("a" * 3000)[-1] == library("a" * 3000)


def test_forgetting_changes_nothing(monkeypatch, counter, library):
    monkeypatch.setattr(token_counts, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(token_counts, "REMEMBERED_PAIRS", 3)
    assert counter.count(PROSE * 3) == library(PROSE * 3) == counter.prefixes(PROSE * 3)[-1]


def test_counts_of_awkward_documents(spark, library):
    docs = documents(spark).withColumn("n_tokens", F.lit("mine"))
    rows = token_counts.count_tokens(docs, limit=100).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        body = r["text"] or ""
        want = library(body)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(body.encode()), want, want > 100)
        cut = r["fitting_chars"]
        assert library(body[:cut]) <= 100
        assert all(library(body[:i]) > 100 for i in range(cut + 1, min(len(body), cut + 30) + 1))
        assert r["kept"] == "mine"


def test_stored_prefixes_answer_questions(spark, library):
    docs = documents(spark, [t for t in TEXTS if len(t or "") < 300], extra=False)
    stored = token_counts.count_tokens(docs, store=True)
    asked = stored.withColumn("at", F.lit(20)).withColumn("budget", F.lit(7))
    rows = token_counts.longest_prefix(token_counts.tokens_at(asked, "at"), "budget").collect()
    for r in rows:
        body = r["text"] or ""
        assert r["tokens_at"] == library(body[:20])
        fits = [i for i in range(len(body) + 1) if library(body[:i]) <= 7]
        assert r["prefix_chars"] == fits[-1]
    none = token_counts.tokens_at(asked.withColumn("at", F.lit(None).cast("int")), "at")
    assert {r["tokens_at"] for r in none.collect()} == {None}


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(documents(spark).limit(0)).count() == 0


def test_packed_ids_are_as_many(spark):
    docs = documents(spark, ["<|endoftext|> is text", "plain", "a<|endoftext|><|endoftext|>b"], repeat=False, extra=False)
    packed = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(docs).collect()}
    counted = {r["doc_id"]: r["n_tokens"] + 1 for r in token_counts.count_tokens(docs).collect()}
    assert packed == counted


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, **changed):
    return h("".join(enc(changed.get(f, row[f])) for f in merkle.FIELDS))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        now = out[-1]
        out.append([h("".join(now[i : i + fanout])) for i in range(0, len(now), fanout)])
    return out


def steps(tree, place, fanout):
    """(before, after) of a leaf, level by level."""
    out = []
    for nodes in tree[:-1]:
        first = place // fanout * fanout
        run = nodes[first : first + fanout]
        out.append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        place //= fanout
    return out


def plain_proofs(rows, changed, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]], fanout)
    top = levels([trees[g][-1][0] for g in order], fanout)
    root = top[-1][0]
    out = []
    for k, g in enumerate(order):
        for place, r in enumerate(groups[g]):
            path = steps(trees[g], place, fanout) + steps(top, k, fanout)
            node = changed(r)
            for before, after in path:
                node = h(before + node + after)
            proof = h("".join(a + b for a, b in path))
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def tampered(r):
    hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
    return leaf(r, n_chars=r["n_chars"] + 1) if hit else leaf(r)


def proved(docs, **options):
    change = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, 1).otherwise(0)
    manifest = merkle.build(docs.withColumn("tampered", F.col("n_chars") + change), tampered={"n_chars": "tampered"}, **options)
    return manifest, sorted(map(tuple, merkle.digest(merkle.prove(manifest)).collect()), key=repr)


@pytest.mark.parametrize("fanout,height", [(2, 10), (2, 2), (3, 2)])
def test_manifest_equals_plain_trees(spark, fanout, height):
    """Several rounds of segments, awkward rows, missing groups and keys, equal rows."""
    docs = documents(spark).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang")))
    more = spark.range(40).select(
        (F.col("id") + 100).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
        F.element_at(F.array(*map(F.lit, ["de", "en", "ä", "z"])), (F.col("id") % 4 + 1).cast("int")).alias("lang"),
        F.lit(None).cast("string").alias("source"), F.col("id").alias("n_chars"),
    )
    docs = docs.select(more.columns).unionByName(more).unionByName(more.where("id < 9"))
    rows = docs.collect()
    manifest, got = proved(docs, fanout=fanout, levels=height)
    assert got == plain_proofs(rows, tampered, fanout)
    assert manifest.root == got[0][3]


def test_equal_rows_without_ids(spark):
    docs = spark.range(37).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars"))
    _, got = proved(docs, levels=2)
    assert got == plain_proofs(docs.collect(), leaf, 2) and all(r[-1] for r in got)


def test_one_row_and_none(spark):
    docs = documents(spark, ["only"], repeat=False)
    manifest, got = proved(docs)
    assert manifest.root == got[0][1] == got[0][2] and got[0][4] == h("")
    manifest, got = proved(docs.limit(0))
    assert manifest.root is None and got == []


def test_chosen_leaves_paths_and_records(spark):
    docs = documents(spark, [f"text {i}" for i in range(30)], repeat=False)
    manifest = merkle.build(docs, levels=2)
    wanted = manifest.leaves.where("key in (3, 29)")
    rows = merkle.prove(manifest, wanted, paths=True).collect()
    assert {r["key"] for r in rows} == {3, 29}
    for r in rows:
        assert merkle.fold(r["leaf"], [s.asDict() for s in r["path"]]) == r["root"] == manifest.root
    held = {r["digest"].hex(): [c.hex() for c in r["children"]] for r in merkle.records(manifest.lower).collect()}
    assert all(h("".join(children)) == digest for digest, children in held.items())


def test_damaged_manifest_is_noticed(spark):
    docs = documents(spark, [f"text {i}" for i in range(30)], repeat=False)
    manifest = merkle.build(docs, levels=2)
    first = manifest.lower.rounds[0]
    manifest.lower.rounds[0] = first.where("place <> 1")
    with pytest.raises(Exception, match="lacks a segment"):
        merkle.prove(manifest).collect()


# Ptolemaic clustering


def plain_clusters(rows, k=40, rounds=5, dimensions=64):
    """(vec_id, cluster, distance) of whole vectors, every distance measured."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    if not kept:
        return [], []
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in hashed[:k]]
    x = np.array([v for _, v in kept], object)

    def nearest():
        d = np.stack([((x - np.array(c, object)) ** 2).sum(1) for c in centers], 1).astype(np.int64)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        at, _ = nearest()
        for c in range(len(centers)):
            members = x[at == c]
            if len(members):
                centers[c] = [int(s) // len(members) for s in members.sum(0)]
    at, d = nearest()
    return [(key, int(a), int(b)) for (key, _), a, b in zip(kept, at, d)], centers


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("mine"))


def compare(spark, rows, **options):
    got = ptolemaic.cluster(vectors(spark, rows), **options).collect()
    want, centers = plain_clusters(rows, options.get("centroids", 40), options.get("rounds", 5))
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == h(",".join(map(str, centers[r["cluster"]])))


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(7, 64)) * 3
    rows = [(i, (centers[i % 7] + rng.normal(size=64) * 0.1).astype(np.float32).tolist()) for i in range(150)]
    compare(spark, rows, centroids=12)


def test_clusters_of_awkward_rows(spark):
    one, two = [0.25] * 64, [-0.5] * 63 + [1.5]
    odd = [None, [], [0.1] * 63, [0.1] * 65, [None] + one[1:], [float("nan")] + one[1:], [float("inf")] + one[1:]]
    rows = [(i, v) for i, v in enumerate(odd)] + [(10, one), (11, one), (11, one), (12, two), (None, two), (13, [0.0] * 64)]
    compare(spark, rows)
    compare(spark, rows, centroids=2)
    assert ptolemaic.cluster(vectors(spark, rows[:7])).count() == 0
    assert ptolemaic.cluster(vectors(spark, []).limit(0)).count() == 0


def test_equal_distances_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 3 - 1)] * 64) for i in range(30)]
    compare(spark, rows, centroids=9, rounds=2)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        ptolemaic.cluster(vectors(spark, [(1, [1e30] * 64)])).collect()


def test_bounds_are_below_distances_and_spare_work():
    rng = np.random.default_rng(4)
    for scale in (3, 300, 1 << 20):
        centers = rng.integers(-scale * 20, scale * 20, size=(12, 64))
        x = centers[rng.integers(0, 12, 400)] + rng.integers(-scale, scale + 1, size=(400, 64))
        pivots = ptolemaic.choose_pivots(centers, 6)
        cached = np.stack([np.sqrt(ptolemaic.squared(x, p[None])) for p in pivots], 1)
        bounds = ptolemaic.Bounds(pivots, centers)
        exact = np.stack([ptolemaic.squared(x, c[None]) for c in centers], 1)
        assert (bounds.below(cached) ** 2 * (1 - ptolemaic.SAFETY) <= exact).all()
        at, best, measured = bounds.nearest(x, cached)
        assert (at == exact.argmin(1)).all() and (best == exact.min(1)).all()
        assert measured < 0.5 * exact.size
        bounds.pairs = []
        assert bounds.nearest(x, cached)[2] >= measured


def test_vectors_of_sliced_batches():
    column = pa.array([[1, 2], [3, 4], [5, 6]], pa.list_(pa.int32())).slice(1)
    assert ptolemaic.matrix(column, 2).tolist() == [[3, 4], [5, 6]]
