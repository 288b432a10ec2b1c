"""Spelling variants, Merkle manifest and source mix against plain versions."""

import random

import brute
import pytest
from fixtures import awkward, empty
from pyspark.sql import functions as F

from tickweave.llm import merkle, mixing, queries, running, variants

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.fixture(scope="module")
def hard(spark):
    """Awkward rows, some of them twice, some without an id, some with another text under the same id."""
    docs = awkward(spark)
    again, unnamed = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 4 = 1").withColumn("doc_id", F.lit(None).cast("long"))
    other = docs.filter("doc_id % 5 = 2").withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" Words again WORDSAGAIN")))
    return docs.unionByName(again).unionByName(unnamed).unionByName(other)


def as_tables(spark, monkeypatch, docs):
    monkeypatch.setattr(queries, "table", lambda *_: docs)


def got_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- Merkle manifest

def test_manifest_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got_rows(queries.op12_merkle_manifest(spark, SF)) == brute.merkle([tuple(r) for r in docs.select(*FIELDS).collect()])


@pytest.mark.parametrize("digits", [1, 2])
def test_manifest_over_many_stages(spark, monkeypatch, digits):
    """Blocks of 16 and 256 leaves: several stages within a source and over the sources."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 16**digits)
    sizes = {"hot": 700, None: 257, "": 256, "b": 17, "é": 16, "z": 1, **{f"s{i:02}": 1 + i % 3 for i in range(20)}}
    rows = [(i, s, None if i % 3 else "en", i, f"Text {i}") for s, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    as_tables(spark, monkeypatch, spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5))
    assert got_rows(queries.op12_merkle_manifest(spark, SF)) == brute.merkle(rows)


def test_manifest_awkward(spark, monkeypatch, hard):
    as_tables(spark, monkeypatch, hard)
    got = got_rows(queries.op12_merkle_manifest(spark, SF))
    assert got == brute.merkle([tuple(r) for r in hard.select(*FIELDS).collect()])
    assert {r[6] for r in got} == {True, False}
    as_tables(spark, monkeypatch, empty(spark))
    assert queries.op12_merkle_manifest(spark, SF).collect() == []


def test_one_document_is_its_own_root(spark, monkeypatch):
    rows = [(7, "s", None, 1, "x")]
    as_tables(spark, monkeypatch, spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    (r,) = queries.op12_merkle_manifest(spark, SF).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == brute.merkle_leaf(rows[0]) and r["proof_sha256"] == brute.sha("")


# --- spelling variants

def as_brute(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variants_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = brute.noisy_words([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert as_brute(queries.op11_spelling_variants(spark, SF)) == brute.variants(words)


def test_variants_awkward(spark, monkeypatch, hard):
    as_tables(spark, monkeypatch, hard)
    got = as_brute(queries.op11_spelling_variants(spark, SF))
    assert got == brute.variants(brute.noisy_words([tuple(r) for r in hard.select("doc_id", "text").collect()])) and got
    as_tables(spark, monkeypatch, empty(spark))
    assert queries.op11_spelling_variants(spark, SF).collect() == []


@pytest.mark.parametrize("bucket", [2, 40, 4096])
def test_buckets_are_cut_without_losing_pairs(spark, monkeypatch, bucket):
    """Words of two letters, many of them near; small buckets are halved until one code point is free."""
    rng = random.Random(bucket)
    n = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))): rng.choice([1, 2, 30, 400]) for _ in range(400)}
    n |= {"x" * 300: 1, "x" * 301: 2, "x" * 299 + "y": 50, "\U0001f600é" * 4: 3, "\U0001f600é" * 3 + "\U0001f600": 2, "\U0001f600": 9}
    monkeypatch.setattr(variants, "BATCH", 50)
    words, _ = queries.written(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3), "words")
    assert as_brute(variants.group_variants(words, bucket=bucket)) == brute.variants(n)


def test_chains_of_forms_end_at_their_root(spark):
    n = {"a" * k + "b" * (20 - k): 11**k for k in range(15)}
    words, _ = queries.written(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    got = as_brute(variants.group_variants(words))
    assert got == brute.variants(n) and {v[1] for v in got.values()} == {"a" * 14 + "b" * 6}


# --- source mix

def close(got, want):
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(r[0], r[1], r[2], r[4]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def test_mix_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = got_rows(queries.op13_source_mix(spark, SF))
    close(got, brute.mixture([tuple(r) for r in docs.select("doc_id", "source", "text").collect()]))
    assert sum(r[4] for r in got) == sum(r[1] for r in got) and all(r[4] <= 3 * r[1] for r in got)


def test_mix_awkward(spark, monkeypatch, hard):
    as_tables(spark, monkeypatch, hard)
    by_size = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[1], r[2], r[4]))
    got, want = got_rows(queries.op13_source_mix(spark, SF)), brute.mixture([tuple(r) for r in hard.select("doc_id", "source", "text").collect()])
    close(by_size(got), by_size(want))
    for docs in (empty(spark), hard.filter("text is null")):
        as_tables(spark, monkeypatch, docs)
        assert all(r["taken"] == 0 and r["target"] == 0 for r in queries.op13_source_mix(spark, SF).collect())


def test_small_sources_stop_and_the_excess_is_shared(spark):
    rows = [(i, "big", "w " * 50) for i in range(200)] + [(1000 + i, "small", "w " * 5) for i in range(4)] + [(2000, "tiny", "w"), (2001, None, "w " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs, ["doc_id", "source"]).collect()
    target = {r["source"]: r["target"] for r in mixed}
    assert (target["small"], target["tiny"], target[None]) == (60.0, 3.0, 90.0) and sum(target.values()) == pytest.approx(10051)
    taken = {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + sum(c["words"] for c in r["copies"])
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)
    # the copies lie end to end
    places = sorted((c["at"], c["words"]) for r in mixed for c in r["copies"])
    assert [a for a, _ in places] == [sum(w for _, w in places[:k]) for k in range(len(places))] and sum(w for _, w in places) == 10051


def test_running_sums_of_ties_and_null_groups(spark):
    rows = [(None if g == 3 else g, i % 2, 1 + i % 3) for g in range(4) for i in range(50 * g * g + 1)]
    df, _ = queries.written(spark.createDataFrame(rows, "g int, o int, v int").repartition(4), "sums")
    got = running.running(df, {"g": F.col("g")}, [F.col("o")], F.col("v"), "t").collect()
    for g in (None, 0, 1, 2):
        mine = sorted((r["o"], r["upto"], r["v"], r["whole"]) for r in got if r["g"] == g)
        total = 0
        for _, upto, v, whole in mine:
            total += v
            assert upto == total and whole == sum(x[2] for x in mine)
