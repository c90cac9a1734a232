"""Each operator against brute force, and on awkward input."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from cases import CLASHING, LONG, PROSE, TEXTS, crc_mod, documents, roots, shingles, words

from pyspark.sql import functions as F

from stayledger.llm import (
    decontaminate,
    language,
    lm_scoring,
    near_dup,
    packing,
    quality_rules,
    ranking,
    secrets,
    sharding,
    toxicity,
)

SF = "/root/testdata/sf0.001"


def docs_of(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


LABELS = [(i, i % 2, (i + 1) % 2) for i in range(10)] + [(None, 1, 1), (3, 1, 0), (4, None, 7)]


# Quality ranking


def test_ranking_takes_awkward_rows(spark):
    docs = documents(spark)
    model = ranking.train(docs, labels(spark, LABELS))
    rows = ranking.score(docs, model).select("doc_id", "score", "predicted").collect()
    assert len(rows) == len(TEXTS) + 2
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["score"])
    assert by_id[0] == by_id[1] == by_id[None]


@pytest.mark.parametrize("module,label", [(ranking, "quality"), (toxicity, "toxic")])
@pytest.mark.parametrize("rows", [[], [(0, 1, 1), (1, 1, 1)]])
def test_labels_of_one_kind(spark, module, label, rows):
    docs = documents(spark)
    model = module.train(docs, labels(spark, rows), label)
    want = 1.0 if rows else (0.5 if module is ranking else 0.0)
    assert {r["score"] for r in module.score(docs, model).select("score").collect()} == {want}


@pytest.mark.parametrize("module,label", [(ranking, "quality"), (toxicity, "toxic")])
def test_no_documents(spark, module, label):
    docs = documents(spark).limit(0)
    model = module.train(docs, labels(spark, LABELS), label)
    assert module.score(docs, model).count() == 0


def test_ranking_orders_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marks = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    train = [r for r in marks.collect() if crc_mod(r["doc_id"], 3) != 1]
    model = ranking.train(docs, spark.createDataFrame(train, marks.schema))
    got = ranking.score(docs, model).join(marks, "doc_id").collect()
    held = [r for r in got if crc_mod(r["doc_id"], 3) == 1]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) >= 0.95


def test_pairwise_fit_needs_no_labels_in_the_score():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(ranking.FEATURES)))
    y = (x[:, 0] + 0.5 * x[:, 3] > 0.4).astype(int)
    model = ranking.fit(x, y, share_bad=float((y == 0).mean()))
    assert ((model.score(x) >= 0.5) == y).mean() > 0.97


# Sharding


def check_shards(rows, n, shards=8):
    assert len(rows) == n
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_are_even_and_whole(spark):
    docs = documents(spark)
    rows = sharding.shuffle_into_shards(docs, bucket_bytes=1 << 14).collect()
    check_shards(rows, docs.count())
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["kept"])
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))


def test_shards_do_not_depend_on_partitions(spark):
    docs = docs_of(spark).select("doc_id", "text")
    a, b = (sharding.shuffle_into_shards(d, bucket_bytes=1 << 16).select("doc_id", "shard", "slot").collect() for d in (docs, docs.repartition(7, "text")))
    check_shards(a, 200)
    assert {tuple(r) for r in a} == {tuple(r) for r in b}
    other = sharding.shuffle_into_shards(docs, bucket_bytes=1 << 16, seed=4).select("doc_id", "shard", "slot").collect()
    assert {tuple(r) for r in a} != {tuple(r) for r in other}


def test_shards_of_nothing(spark):
    assert sharding.shuffle_into_shards(documents(spark).limit(0)).count() == 0


def test_written_shards_read_back(spark, tmp_path):
    docs = docs_of(spark).select("doc_id", "text")
    sharded = sharding.shuffle_into_shards(docs)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {tuple(r) for r in back.select("doc_id", "text").collect()} == {tuple(r) for r in docs.collect()}


def test_shuffle_is_uniform():
    seen = collections.Counter(tuple(sharding.fisher_yates(3, 1, b)) for b in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_shard_digest(spark):
    rows = sharding.digest(sharding.shuffle_into_shards(documents(spark, extra=False))).collect()
    text = dict(enumerate(TEXTS))
    for r in rows:
        body = (text.get(r["doc_id"], PROSE) or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "rows", None)


# Packing


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents(spark)
    pieces = packing.pack(docs, group_bytes=1 << 16).collect()
    text = dict(enumerate(TEXTS))
    parts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] <= packing.SEQUENCE
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        parts[p["doc_id"]].append((p["start"], ids.tolist(), p["doc_tokens"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    for doc_id, found in parts.items():
        body = text.get(doc_id, PROSE) or ""
        want = tokenizer.encode(body, add_special_tokens=False).ids + [packing.END_ID]
        copies = 2 if doc_id == 0 else 1
        assert sum(len(ids) for _, ids, _ in found) == copies * len(want)
        assert all(n == len(want) and ids == want[a : a + len(ids)] for a, ids, n in found)


def test_packing_pads_little(spark):
    pieces = packing.digest(packing.pack(docs_of(spark))).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    used = [r["n"] for r in pieces.collect()]
    assert sum(2048 - n for n in used) < 0.02 * 2048 * len(used) + 2048


def test_packing_nothing(spark):
    assert packing.pack(documents(spark).limit(0)).count() == 0


def test_first_fit_decreasing_equals_plain_search():
    rng = random.Random(3)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(1, 80))), reverse=True)
        bins, offsets = packing.first_fit_decreasing(np.array(sizes), 50)
        used, want = [], []
        for s in sizes:
            k = next((i for i, u in enumerate(used) if s != 50 and u + s <= 50 and i not in full), None) if (full := {i for i, u in enumerate(used) if u == 50}) is not None else None
            if k is None:
                k = len(used)
                used.append(0)
            want.append((k, used[k]))
            used[k] += s
        assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == want


# Near-duplicates


def near(spark, docs):
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect()}


def test_near_duplicates_awkward_rows(spark):
    docs = documents(spark)
    root = roots({i: shingles(t) for i, t in enumerate(TEXTS)})
    want = {(i, len(shingles(t)), root[i], root[i] == i) for i, t in enumerate(TEXTS)}
    want.add((None, len(shingles(PROSE)), None, True))
    assert near(spark, docs) == want
    assert near_dup.near_duplicates(docs).count() == docs.count()


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(documents(spark).limit(0)).count() == 0


def test_near_duplicates_all_unlike(spark):
    docs = documents(spark, ["one two three four five six", "a b c d e f"], repeat=False)
    assert near(spark, docs) == {(0, 2, 0, True), (1, 2, 1, True)}


def test_near_duplicates_equal_brute_force(spark):
    """Chains, groups around an original that is not the smallest id, and shared passages."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(6):
        base, group = fresh(120), []
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice((1, 2, 3, 4))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            group.append(" ".join(w))
        chain = list(base)
        for _ in range(8):
            chain = chain[6:] + fresh(6)
            group.append(" ".join(chain))
        texts += group + [" ".join(base)]
    passage = fresh(60)
    texts += [" ".join(fresh(rng.randrange(5, 60)) + passage + fresh(rng.randrange(5, 60))) for _ in range(60)]
    rng.shuffle(texts)
    docs = documents(spark, texts, repeat=False, extra=False)
    root = roots({i: shingles(t) for i, t in enumerate(texts)})
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == root


def test_near_duplicates_judge_rows_that_repeat_an_id_by_their_texts(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    bases = [fresh(80) for _ in range(6)]
    near_copy = lambda w: " ".join(w[:-1] + fresh(1))
    # All bases have one id, and so has a near copy of the first; each base has a near copy elsewhere.
    rows = [(1, " ".join(b)) for b in bases] + [(1, near_copy(bases[0])), (1, None)]
    rows += [(10 + i, near_copy(b)) for i, b in enumerate(bases)] + [(20, " ".join(fresh(50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect())
    # Six bases and the row without words are kept, the near copy of the first base is not.
    want = [(1, 1, False)] + [(1, 1, True)] * 7 + [(10 + i, 1, False) for i in range(6)] + [(20, 20, True)]
    assert got == want


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40, 0, -1)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in near_dup.components(links).collect()}
    assert got == {**{i: 1 for i in range(2, 42)}, 101: 100}


def test_signature_is_circulant():
    sets = near_dup.shingle_sets([PROSE.encode(), LONG.encode()])
    signature = near_dup.signatures(sets, 8)
    every = (sets[0] ^ (sets[0] >> np.uint64(32))).astype(np.uint32) ^ np.uint32(0x5BD1E995)
    first = near_dup.permuted(every, np.empty_like(every))
    for k in range(8):
        moved = first + np.uint32(k)
        assert signature[0, k] == near_dup.permuted(moved, np.empty_like(moved)).min()


# Language-model scores


def test_lm_base_scores(spark):
    docs = documents(spark)
    trains = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    rows = lm_scoring.score(docs, trains).collect()
    text = {**dict(enumerate(TEXTS)), None: PROSE}
    all_ids = [*range(len(TEXTS)), 0]
    count = collections.Counter()
    for i in all_ids:
        if crc_mod(i, 7) != 2:
            count.update([*words(text[i]), None])
    n, v = sum(count.values()), len(count)
    assert len(rows) == len(all_ids) + 1
    for r in rows:
        found = [*words(text[r["doc_id"]]), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in found)
        assert r["n_tokens"] == len(found) and r["n_known"] == sum(count[w] > 0 for w in found)
        assert r["train_tokens"] == n and r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_lm_without_training(spark):
    docs = documents(spark, ["a b", ""], repeat=False)
    rows = lm_scoring.score(docs, F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(0, 3, 0, 0), (1, 1, 0, 0)}
    assert all(r["base_score"] == pytest.approx(0) for r in rows)
    assert lm_scoring.score(docs.limit(0), F.lit(True)).count() == 0


def test_lm_spelling_is_a_distribution():
    """Bits of all tokens of one byte and their completions never exceed probability 1."""
    counts = [np.zeros((lm_scoring.PREDICTORS, lm_scoring.SLOTS), np.float32) for _ in range(2)]
    weights, refiner, _ = lm_scoring.learn_online(iter([[b"the", b"then", b"a"]]), *[c + 3 for c in counts])
    inputs = np.zeros((lm_scoring.PREDICTORS, lm_scoring.SLOTS), np.float32)
    speller = lm_scoring.Speller(inputs, weights, refiner)
    total = sum(10 ** speller.log10([bytes([b])]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)).item()
    assert 0 < total + 10 ** speller.log10([b""])[0] <= 1


def test_lm_adaptation_is_the_product_of_steps():
    p, n, a = 0.03, 7, 100.0
    steps = math.prod(a * p + i for i in range(n))
    assert lm_scoring.log10_rising(np.array([a * p]), np.array([n]))[0] == pytest.approx(math.log10(steps))


def test_lm_prefers_known_language(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(400)
    trains = F.col("doc_id") % 5 != 0
    rows = lm_scoring.score(docs, trains).collect()
    seen = [r for r in rows if r["doc_id"] % 5]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)


# Toxicity


def test_kernel_tolerates_gaps():
    kernel = toxicity.Kernel(["stupid", "worthless"])
    value = dict(zip(("stupid", "stxupid", "stuppid", "stpid", "river"), kernel.values(["stupid", "stxupid", "stuppid", "stpid", "river"])[:, 0]))
    assert value["stupid"] == pytest.approx(1, abs=1e-5)
    assert value["stuppid"] > 10 * max(value["river"], 1e-3)
    assert value["stxupid"] > 10 * max(value["river"], 1e-3)
    assert value["river"] == 0


def test_kernel_equals_plain_sum():
    def plain(s, t):
        def parts(x):
            out = collections.Counter()
            for i in range(len(x)):
                for k in range(i + 2, min(len(x), i + toxicity.SPAN)):
                    for j in range(i + 1, k):
                        out[x[i] + x[j] + x[k]] += toxicity.DECAY ** (k - i + 1)
            return out

        a, b = parts(s), parts(t)
        dot = lambda u, v: sum(w * v[key] for key, w in u.items())
        value = dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) if a and b else 0
        value = value**toxicity.POWER
        return value if value >= toxicity.FLOOR else 0

    strings = ["banana", "bananas", "nab", "cabana", "aaaaaa", "ab"]
    got = toxicity.Kernel(strings[:3]).values(strings)
    for i, s in enumerate(strings):
        for j, t in enumerate(strings[:3]):
            assert got[i, j] == pytest.approx(plain(s, t), abs=1e-4)


def test_toxicity_learns_and_takes_awkward_rows(spark):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in ("lan", "mor", "tis") for b in ("eth", "oru") for c in ("ing", "al", "en", "um")]
    sentence = lambda: " ".join(rng.choice(vocabulary) for _ in range(8)).capitalize() + "."
    rows, marks = [], []
    for i in range(240):
        toxic = i % 3 == 0
        parts = [sentence() for _ in range(5)]
        if toxic:
            parts[2] = parts[2][:-1] + " " + rng.choice(("blockhead", "nitwit", "scoundrel")) + "."
        rows.append((i, " ".join(parts)))
        marks.append((i, None, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, labels(spark, [m for m in marks if crc_mod(m[0], 5)]))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    held = [m for m in marks if not crc_mod(m[0], 5)]
    assert sum(got[i] == t for i, _, t in held) / len(held) >= 0.95
    odd = [(1, "What a blockkhead."), (2, "Such a b.l.o.c.k.h.e.a.d indeed."), (3, "a scounxdrel"), (4, sentence())]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert min(found[1], found[2], found[3]) > found[4]
    awkward = toxicity.score(documents(spark), model).select("score", "predicted").collect()
    assert len(awkward) == len(TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in awkward)


def test_toxicity_counts_over_the_whole_document(spark):
    """One typical word also occurs in clean documents; two in different sentences tell toxic ones."""
    rng = random.Random(4)
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(150)]
    bad = ["zwuxk" + x for x in ("are", "opi", "ul", "enta", "iso", "odu")]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 3 == 0
        sentences = [[rng.choice(plain) for _ in range(8)] for _ in range(6)]
        for k, word in enumerate(rng.sample(bad, 2 if toxic else i % 2)):
            sentences[2 * k][3] = word
        rows.append((i, " ".join(" ".join(x) + "." for x in sentences)))
        marks.append((i, None, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, labels(spark, [m for m in marks if crc_mod(m[0], 5)]))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    held = [m for m in marks if crc_mod(m[0], 5) == 0]
    assert np.mean([got[i] == y for i, _, y in held]) > 0.95


def test_all_significant_units_are_landmarks(spark):
    """Many typical words, each of them rare."""
    rng = random.Random(6)
    bad = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(100)]
    rows = [(1, f"{bad[i % 100]} and {bad[(i * 7 + 3) % 100]} here") for i in range(600)] + [(0, "and here is nothing")] * 3000
    docs = spark.createDataFrame(rows, "y int, text string")
    landmarks, toxic = toxicity.choose_landmarks(docs, {0: 3000, 1: 600})
    assert set(landmarks[:toxic]) == set(bad)


def test_toxicity_tolerates_inserted_characters(spark):
    """Every insult of the held-out documents gets one more letter than in training."""
    rng = random.Random(9)
    syllables = ("lan", "mor", "tis", "eth", "oru", "al", "en", "um", "pex", "dra")
    plain = ["".join(rng.sample(syllables, 3)) for _ in range(200)]
    bad = ["blockhead", "nitwit", "scoundrel", "villain", "wretch", "fiendish"]
    rows, marks = [], []
    for i in range(600):
        toxic, held = i % 3 == 0, crc_mod(i, 5) == 0
        words_ = [rng.choice(plain) for _ in range(40)]
        if toxic:
            for w in rng.sample(bad, 2):
                at = rng.randrange(1, len(w))
                words_.insert(rng.randrange(40), w[:at] + rng.choice("bdfgjkqvz") + w[at:] if held else w)
        rows.append((i, " ".join(words_) + "."))
        marks.append((i, None, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, labels(spark, [m for m in marks if crc_mod(m[0], 5)]), tolerance=1.0)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i], y) for i, _, y in marks if crc_mod(i, 5) == 0]
    assert sum(g for g, y in held if y) >= 0.9 * sum(y for _, y in held)
    assert sum(g for g, y in held if not y) == 0


# Languages


def test_language_evidence(spark):
    docs = docs_of(spark)
    page = "<html{}><body><p>{}</p></body></html>"
    text = {r["lang"]: r["text"] for r in docs.where("n_chars between 800 and 3000").collect()}
    rows = [(i, f"http://h.example.{lang}/x", page.format(f' lang="{lang}"', t)) for i, (lang, t) in enumerate(text.items())]
    rows += [(50, None, None), (51, "", ""), (52, "nonsense", "<p>"), (53, "http://h.example.de/", ""), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("mine"))
    got = language.identify(pages, docs).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r["lang"] for r in got}
    assert all(by_id[i] == lang for i, lang in enumerate(text))
    assert all(0 < r["probability"] <= 1 for r in got)
    none = language.identify(pages, docs.limit(0)).collect()
    assert len(none) == len(rows) and {r["lang"] for r in none} == {None}
    assert language.identify(pages.limit(0), docs).count() == 0


def test_language_of_the_given_pages(spark):
    got = language.identify(docs_of(spark, "pages"), docs_of(spark)).where("declared is not null").collect()
    assert sum(r["lang"] == r["declared"] for r in got) / len(got) > 0.9


# Quality rules


def test_rule_signals_equal_plain_counts(spark):
    rows = quality_rules.signals(documents(spark).select("doc_id", "text", "_w")).collect()
    text = {**dict(enumerate(TEXTS)), None: PROSE}
    from cases import WORD

    for r in rows:
        body = text[r["doc_id"]] or ""
        w = WORD.findall(body)
        threes = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {j for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in body.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(body.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want


def test_rules_keep_and_drop(spark):
    prose = [" ".join(f"{w}{i}{j}" for j, w in enumerate(["alpha", "beta", "gamma", "delta"] * 20)) + "." for i in range(30)]
    noise = [" ".join(f"{w}{i}{j}###" for j, w in enumerate(["alpha", "beta", "gamma", "delta"] * 20)) for i in range(6)]
    docs = documents(spark, prose + noise, repeat=False)
    got = quality_rules.judge(quality_rules.signals(docs)).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == set(range(30))
    empty = quality_rules.judge(quality_rules.signals(docs.limit(0)))
    assert empty.count() == 0


def test_rules_run_no_python(spark):
    plan = quality_rules.judge(quality_rules.signals(docs_of(spark)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# Secrets


def test_secrets_are_told_from_lookalikes(spark):
    words = secrets.frequent_words(docs_of(spark))
    known = secrets.Dictionary.of(words)
    forest = secrets.train(secrets.labelled_findings(words), known)
    held = secrets.labelled_findings(words, n=600, seed=99)
    p = forest.probability(np.array([secrets.features(c, b, a, known) for c, b, a, _ in held]))
    assert np.mean((p >= 0.5) == np.array([f[3] for f in held])) > 0.97
    rows = secrets.scan(documents(spark), forest, known).select("doc_id", "text", "secrets", "redacted").collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(TEXTS) + 2
    assert by_id[13]["redacted"] == 'see token = "[secret]" here'
    assert all(r["redacted"] == r["text"] for r in rows if r["doc_id"] != 13)


def test_short_and_marked_passwords_are_masked(spark):
    words = secrets.frequent_words(docs_of(spark))
    known = secrets.Dictionary.of(words)
    forest = secrets.train(secrets.labelled_findings(words), known)
    values = ["hunter2022", "Tr0ub4dor&3", "a8F3kq9Z", "xK9!mQ2@vL5#", "Winter2023!", "p4ss;w0rd'77x%Q", "9f8e7d6c5b4a"]
    texts = [f'we set {name} = "{v}" there' for v in values for name in ("password", "api_key")]
    texts += ["login with pwd=Zx81!kk20q and go on", "{'passwd': 'Qw3rty#987', 'user': 'me'}"]
    plain = ["password: required", "the token = get_token() call", 'secret: "something" else', "pwd=$PASSWORD", "password = ********"]
    rows = [(i, t) for i, t in enumerate(texts + plain)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), forest, known)
    got = [r["redacted"] for r in sorted(found.collect(), key=lambda r: r["doc_id"])]
    assert got[: 2 * len(values)] == [f'we set {n} = "[secret]" there' for _ in values for n in ("password", "api_key")]
    assert got[2 * len(values) : len(texts)] == ["login with pwd=[secret] and go on", "{'passwd': '[secret]', 'user': 'me'}"]
    assert got[len(texts) :] == plain


def test_secrets_without_findings(spark):
    rows = secrets.find_secrets(documents(spark), findings=[]).collect()
    assert all(r["secrets"] == [] and r["redacted"] == r["text"] for r in rows)
    assert secrets.find_secrets(documents(spark).limit(0)).count() == 0


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((600, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((secrets.Forest(x, y).probability(x) >= 0.5) == y).mean() > 0.9


# Decontamination


def plain_hits(text, items, window=10):
    found, hit, names = decontaminate.words((text or "").encode()), set(), set()
    for name, item in items:
        w = decontaminate.words((item or "").encode())
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(found) - k + 1):
                if found[j : j + k] == w[i : i + k]:
                    hit.update(range(j, j + k))
                    names.add(name)
    return len(found), len(hit), sorted(names)


ITEMS = [(1, PROSE), (2, "brown fox"), (10, "BROWN-FOX!"), (3, ""), (4, None), (None, "dog"), (5, "word1 word2 word3 " * 5), (6, "naïve"), (2, "lazy dog")]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 40])
def test_benchmark_search_equals_plain_search(spark, pass_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("items", F.lit("mine"))
    found = decontaminate.find_benchmark_text(documents(spark), benchmark, pass_bytes=pass_bytes)
    text = {**dict(enumerate(TEXTS)), None: PROSE}
    items = [(str(i), t) for i, t in ITEMS if i is not None]
    rows = found.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == plain_hits(text[r["doc_id"]], items)


def test_benchmark_items_without_an_id_are_hits(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(None, passage), ("a", "red green blue")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"see {passage} there"), (2, "red green blue"), (3, "none")], "doc_id long, text string")
    for pass_bytes in (1 << 20, 20):
        found = decontaminate.find_benchmark_text(docs, benchmark, pass_bytes=pass_bytes).collect()
        assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in found} == {1: (11, []), 2: (3, ["a"]), 3: (0, [])}


def test_benchmark_search_with_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in decontaminate.digest(decontaminate.find_benchmark_text(documents(spark), none)).collect()} == {False}
    assert decontaminate.find_benchmark_text(documents(spark).limit(0), none).count() == 0


def test_wu_manber_finds_overlapping_patterns():
    rng = random.Random(8)
    for _ in range(50):
        text = [rng.choice([b"a", b"b"]) for _ in range(60)]
        patterns = list({tuple(rng.choice([b"a", b"b"]) for _ in range(4)) for _ in range(3)})
        got = set(decontaminate.WuManber(patterns, 4).find(text))
        want = {(i + 4, n) for n, p in enumerate(patterns) for i in range(57) if tuple(text[i : i + 4]) == p}
        assert got == want


def test_clashing_names_are_covered():
    assert {"score", "kept", "shard", "items", "ids", "redacted"} <= set(CLASHING)
