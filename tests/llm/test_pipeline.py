"""The pipeline against its stages' plain versions, and on awkward tables; the queries against their SQL."""

import gc
import importlib.util
import os

import brute
import corpus_pipeline
import pytest
from fixtures import awkward, empty
from test_documents import check_packing, pairs

from tickweave import session
from tickweave.llm import quality_rules, queries, secret_scan, simhash

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def redacted(text):
    out, at = "", 0
    for a, k, b in secret_scan.find(text or ""):
        if a >= at:
            out += text[at:a] + f"[{secret_scan.KINDS[k]}]"
        at = max(at, b)
    return None if text is None else out + text[at:]


def left_by_plain_versions(spark, docs):
    """(doc_id, text) that reach the last stage."""
    good = {r["doc_id"] for r in quality_rules.judge(docs.select("doc_id", "source", "text")).filter("kept").select("doc_id").collect()}
    rows = [(d, t) for d, t in pairs(docs) if d in good]
    assert all(not brute.rules(t)["base_failed"] for _, t in rows)
    kept = brute.exact(rows)
    rows = [(d, t) for d, t in rows if kept[d][2]]
    comp = brute.components([(d, brute.fingerprint(t)) for d, t in rows])
    return [(d, redacted(t)) for d, t in rows if comp[d] == d]


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
        out.append(docs)
    return out


@pytest.mark.parametrize("kind", ["documents", "awkward"])
def test_stages_do_what_their_plain_versions_do(spark, kind):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if kind == "documents" else awkward(spark)
    want = left_by_plain_versions(spark, docs)
    got = stages(spark, docs)
    assert sorted(pairs(got[3])) == sorted(want)
    lengths = {r["doc_id"]: r["n_chars"] for r in got[3].collect()}
    assert all(lengths[d] == (None if t is None else len(t)) for d, t in want)
    check_packing(got[3], got[4].collect())


def test_run_writes_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {d for d, _ in left_by_plain_versions(spark, docs)}
    assert {r["doc_id"] for r in queries.QUERIES["pipeline"](spark, SF).collect()} == want


def test_empty_table_goes_through(spark):
    assert [df.count() for df in stages(spark, empty(spark))] == [0] * 5


def test_tables_live_as_long_as_what_reads_them(spark):
    rules, exact = queries.op5_quality_rules(spark, SF), queries.op6_exact_dedup(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert queries.pipeline(spark, SF).count() > 0
    assert (rules.count(), exact.filter("kept").count() <= n, exact.count()) == (n, True, n)
    before = set(session._SCRATCH)
    del rules, exact
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        spark.range(1).count()
    session.sweep(spark)
    assert len(set(session._SCRATCH) & before) < len(before)


def test_repeated_and_null_ids_stay_rows_of_their_own(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(90))
    near = words(0) + " tail"
    rows = [(1, words(0)), (2, near), (2, words(1)), (3, words(2)), (3, words(2)), (None, words(3)), (None, words(3) + " end"), (None, words(4)), (4, "short"), (4, words(5))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert brute.components([(0, brute.fingerprint(words(0))), (1, brute.fingerprint(near))])[1] == 0
    got = simhash.near_dedup(docs)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert [(d, t) for d, t in kept if t in (words(0), near, words(1))] == [(1, words(0)), (2, words(1))]
    assert [d for d, t in kept if t == words(2)] == [3]
    assert len([d for d, t in kept if d is None]) == 2 and (None, words(4)) in kept
    out = stages(spark, docs)
    want = sorted([(1, words(0)), (2, words(1)), (3, words(2)), (4, words(5)), (None, words(4))], key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in out[2].collect()), key=str)
    assert [x for x in left if x[1] not in (words(3), words(3) + " end")] == want and len(left) == len(want) + 1
    assert out[4].select("doc_id").count() == len(left)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    spec = importlib.util.spec_from_file_location("oracle_check", f"{REPO}/tools/oracle_check.py")
    duck = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(duck)
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck.duck(SF).execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert (duck.normalise(got) == duck.normalise(want)).all(axis=None)
