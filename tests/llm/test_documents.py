"""Operators on ``documents`` against plain versions, on sf0.001 and on awkward rows."""

import hashlib
import zlib

import brute
import pyarrow as pa
import pytest
from fixtures import awkward, empty
from pyspark.sql import functions as F

from tickweave.llm import exact_dedup, packing, quality_rules, queries, secret_scan, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    out = {r["doc_id"]: r for r in df.collect()}
    return out


def check_exact(df, got):
    want = brute.exact(pairs(df))
    assert len(got) == len(want)
    assert {d: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for d, r in got.items()} == want


def test_exact_query(spark, docs):
    check_exact(docs, by_id(queries.op6_exact_dedup(spark, SF)))


def test_exact_awkward(spark):
    df = awkward(spark)
    digest = F.sha2(exact_dedup.normalised(F.coalesce("text", F.lit(""))), 256)
    got = exact_dedup.exact_groups(df.select("doc_id", "text").withColumn("text_sha256", digest), carry=["doc_id", "text_sha256"])
    check_exact(df, by_id(got))
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    want = brute.exact(pairs(df))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, v in want.items() if v[2])
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_exact_repeated_ids_and_null_ids(spark):
    rows = [(1, "a b"), (1, "a  b"), (2, "a b"), (None, "a b"), (None, "c"), (None, "c"), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((exact_dedup.exact_groups(df).select("keep_id", "group_size", "kept").collect()), key=str)
    assert [tuple(r) for r in got if r["keep_id"] == 1 and r["kept"]] == [(1, 4, True)]
    assert [tuple(r) for r in got if r["keep_id"] is None] == [(None, 2, False), (None, 2, True)]
    assert [tuple(r) for r in got if r["keep_id"] == 3] == [(3, 2, False), (3, 2, True)]
    assert len(got) == len(rows)


def check_rules(df, got, host):
    for d, t in pairs(df):
        want = brute.rules(t)
        assert {k: got[d][k] for k in want} == want, (d, t and t[:80])
    hosts = {r["doc_id"]: r[host] for r in df.select("doc_id", host).collect()}
    n, k = {}, {}
    for d, h in hosts.items():
        if h is not None:
            n[h] = n.get(h, 0) + 1
            k[h] = k.get(h, 0) + got[d]["base_failed"]
    mean = sum(k.values()) / sum(n.values())
    spread = sum(n[h] * (k[h] / n[h] - mean) ** 2 for h in n) / sum(n.values())
    weight = min(max(mean * (1 - mean) / spread - 1 if spread > 0 else 1e6, 1), 1e6)
    for d, h in hosts.items():
        rate = None if h is None else (k[h] + mean * weight) / (n[h] + weight)
        assert got[d]["host_rate"] == (rate if rate is None else pytest.approx(rate, abs=1e-9))
        assert got[d]["kept"] == (not got[d]["base_failed"] and (rate is None or rate < quality_rules.MAX_HOST_RATE))


def test_rules_query(spark, docs):
    check_rules(docs, by_id(queries.op5_quality_rules(spark, SF)), "source")


def test_rules_awkward(spark):
    df = awkward(spark)
    got = by_id(quality_rules.judge(df.select("doc_id", "text", "source"), carry=["doc_id"]))
    check_rules(df, got, "source")
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d in got if got[d]["kept"])
    assert quality_rules.keep_good(empty(spark)).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(i, words if i % 10 == 0 else "junk", "bad") for i in range(100)] + [(100 + i, words, f"good{i % 9}") for i in range(300)]
    got = by_id(quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert not any(got[i]["kept"] for i in range(100))
    assert all(got[i]["kept"] for i in range(100, 400))


def check_simhash(df, got):
    fps = [(d, brute.fingerprint(t)) for d, t in pairs(df)]
    comp = brute.components(fps)
    assert got == {d: (f"{fp:016x}", comp[d]) for d, fp in fps}


def test_simhash_query(spark, docs):
    check_simhash(docs, {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op3_simhash_dedup(spark, SF).collect()})


def test_simhash_awkward(spark):
    df = awkward(spark)
    got = {r["id"]: (f"{r['fp'] & (2**64 - 1):016x}", r["component"]) for r in simhash.near_groups(df).collect()}
    check_simhash(df, got)
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in got.values()})
    assert simhash.near_groups(empty(spark)).count() == 0


def test_covering_misses_no_pair_within_the_radius():
    import itertools

    for level in range(3):
        tables = simhash.masks(level)
        for r in range(1, 4):
            for where in itertools.combinations(range(64), r):
                diff = sum(1 << i for i in where)
                assert any(diff & m == 0 for m in tables)
    free = max(64 - bin(a | b | c).count("1") for a in simhash.masks(0) for b in simhash.masks(1) for c in simhash.masks(2))
    assert 2**free <= simhash.BUCKET


def test_links_of_crowded_buckets(spark):
    import random

    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = list({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))) for _ in range(250)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [(simhash._signed(f),) for f in fps]
    want = brute.components([(simhash._signed(f), f) for f in fps])
    df = spark.createDataFrame(signed, "fp long")
    for bucket in (4096, 8):  # the second makes the second and third coverings work
        stars = {r["u"]: r["v"] for r in simhash.components(simhash.links(df, bucket)).collect()}
        assert {f: stars.get(f, f) for (f,) in signed} == want


def test_components_of_a_long_chain(spark):
    edges = [(i + 1, i) for i in range(300)] + [(1000 + i, 1001 + i) for i in range(5)]
    stars = {r["u"]: r["v"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert stars == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1006)}}


def check_secrets(df, got):
    for d, t in pairs(df):
        base = brute.secrets(t)
        r = got[d]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        joined = brute.spans_text(base, brute.KINDS)
        assert r["base_sha256"] == brute.sha(joined)
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_private_keys_are_found_to_their_end_line():
    keys = lambda t: [t[a:b] for a, k, b in secret_scan.find(t) if secret_scan.KINDS[k] == "private_key"]
    line = "MIIEpAIBAAKCAQEA" * 4
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    for body in (f"\n{line}\nAb+/=\n", f"\\n{line}\\nAb+/=\\n", f"\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A-1B\n\n{line}\n", f'\\n" +\n  "{line}\\n" +\n  "'):
        key = begin + body + end
        assert keys(f'k = "{key}" and more {key}.') == [key, key]
    assert keys(f"{begin}\n{line}\\n{line}\nthen prose {begin} in a text") == [f"{begin}\n{line}\\n{line}", begin]
    assert len(keys(begin * 50_000)) == 50_000 and keys(begin + "- " * 200_000) == [begin]


def test_secrets_query(spark, docs):
    check_secrets(docs, by_id(queries.op2_secret_scan(spark, SF)))


def test_secrets_awkward(spark, tmp_path):
    df = awkward(spark)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check_secrets(df, by_id(queries.op2_secret_scan(spark, str(tmp_path))))
    out = by_id(secret_scan.redact(df, secret_scan.new_ledger(spark)))
    assert len(out) == df.count()
    for r in df.collect():
        spans = secret_scan.find(r["text"] or "")
        new, at = "", 0
        for a, k, b in spans:
            if a >= at:
                new += (r["text"][at:a]) + f"[{secret_scan.KINDS[k]}]"
            at = max(at, b)
        new = None if r["text"] is None else new + r["text"][at:]
        assert out[r["doc_id"]]["text"] == new
        assert out[r["doc_id"]]["n_chars"] == (None if new is None else len(new))


def test_ledger_scans_only_what_is_new(spark, monkeypatch):
    ledger = secret_scan.new_ledger(spark)
    one = spark.createDataFrame([(1, "password=abcdef"), (2, "clean"), (3, "clean")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "password=abcdef"), (4, "password=abcdef"), (5, "token: 123456"), (None, None)], "doc_id long, text string")
    count = lambda: spark.read.parquet(ledger).count()
    secret_scan.scan_unseen(one, ledger)
    assert count() == 2
    secret_scan.scan_unseen(one, ledger)
    assert count() == 2
    got = sorted(((r["doc_id"], len(r["spans"])) for r in secret_scan.findings(two, ledger).collect()), key=str)
    assert got == [(1, 1), (4, 1), (5, 1), (None, 0)]
    assert count() == 4
    monkeypatch.setattr(secret_scan, "RULES", "other")
    secret_scan.scan_unseen(one, ledger)
    assert count() == 6


def check_packing(df, rows, capacity=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, used = {}, {}
    for d, text in pairs(df):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[d, k] = (a, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used), sum(v[1] for v in want.values())


def test_packing_query(spark, docs):
    n, tokens = check_packing(docs, queries.op7_best_fit_packing(spark, SF).collect())
    assert n <= 1.02 * tokens / 2048 + 2


def test_packing_awkward(spark):
    df = awkward(spark)
    check_packing(df, packing.pack_documents(df).collect())
    check_packing(df, packing.pack_documents(df, capacity=64).collect(), 64)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_words_apart_give_the_same_ids():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng, table = random.Random(6), packing.WordTable(packing.encoder())
    alphabet = [" ", "\n", "a", "Be", "don't", "'s", "'", "42", "é", "É", "ß", "ÿ", "×", "²", "½", "µ", "º", "-", "!", "...", "<|endoftext|>", "<|", "|>", "e\u0301",
                "\u0130", "\u1e9e", "\x85", "\xa0", "\x1c", "\t", "中", "\U0001f600", "Σ", "ﬁ", "_", "'LL", "#$"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(4000)]
    for text, ids in zip(texts, table.texts(pa.array(texts), packing.split_words)):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_layout_takes_every_piece_and_overfills_nothing():
    import random

    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.randrange(1, 60)
        counts = {x: rng.randrange(1, 40) for x in rng.sample(range(1, capacity + 1), rng.randrange(1, capacity + 1))}
        plan = packing.layout(counts, capacity)
        bins: dict[int, list] = {}
        for length, n in counts.items():
            own = plan[plan["length"] == length].reset_index(drop=True)
            assert own["first"][0] == 0
            for rank in range(n):
                r = own[own["first"] <= rank].iloc[-1]
                nth = rank - r["first"]
                bins.setdefault(r["sequence"] + nth // r["each"], []).append((r["offset"] + nth % r["each"] * length, length))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity


def test_digest_of_nothing():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()


def test_a_blob_entered_twice_is_found_once_and_a_rerun_moves_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "token: abcdefgh"), (2, "none"), (2, "see ftp://u:" + "p" * 80 + "@h")], "doc_id long, text string")
    ledger = secret_scan.new_ledger(spark)
    first = sorted((r["doc_id"], len(r["spans"])) for r in secret_scan.findings(docs, ledger).collect())
    assert first == [(1, 1), (2, 0), (2, 1)]
    entries, _ = queries.written(spark.read.parquet(ledger), "ledger-copy")
    entries.write.mode("append").partitionBy("rules").parquet(ledger)
    monkeypatch.setattr(secret_scan, "_scan", None)  # nothing is scanned again
    assert sorted((r["doc_id"], len(r["spans"])) for r in secret_scan.findings(docs, ledger).collect()) == first
