"""SentencePiece, personal data and language against the libraries, plain versions and held-out labels."""

import re
import zlib

import brute
import pyarrow as pa
import pytest
from fixtures import awkward, awkward_texts, empty

from tickweave.llm import language_id, pii, queries, sentencepieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.model_path())


def check_pieces(library, df, got):
    rows = df.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_eos=True)
        x = got[r["doc_id"]]
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids)))


def test_pieces_query(spark, docs, library):
    check_pieces(library, docs, {r["doc_id"]: r for r in queries.op1_sentencepiece(spark, SF).collect()})


def test_pieces_awkward(spark, library):
    df = awkward(spark)
    check_pieces(library, df, {r["doc_id"]: r for r in sentencepieces.round_trip(df).collect()})
    rows = {r["doc_id"]: r for r in sentencepieces.decode(sentencepieces.encode(df)).collect()}
    for r in df.collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        assert rows[r["doc_id"]]["ids"] == ids and rows[r["doc_id"]]["decoded"] == library.decode(ids)
    assert sentencepieces.round_trip(empty(spark)).count() == 0


def test_chunks_alone_give_the_same_ids(library):
    import random

    rng = random.Random(5)
    encode = sentencepieces.chunk_encoder(library)
    alphabet = [" ", " ", "  ", "a", "the", "ing", "é", "\n", "\t", "▁", "\U0001f600", "\x00", "<s>", "</s>", "<0x41>", "Ω", ".", "42", "́", "ﬁ"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 25)))
        chunks = sentencepieces.split_chunks(pa.array([text])).flatten()
        assert encode(chunks)[0].tolist() == library.encode(text), repr(text)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    import random

    rng = random.Random(11)
    parts = ["a", "b.c", "@", "@", ".", "x-y", " ", "1", "255", "256", "0007", "12.3.4.5", "4387513035237269", "4387 5130 3523 7269", "+", "+1 (988) 555-2485", "-", "(", ")", "é", "%", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))
        assert pii.base_spans(text) == private(text), repr(text)
    assert pii.base_spans("a" * 200_000 + "@" + "9" * 200_000) == []


def check_private(rows, got):
    for r in rows:
        base = private(r["text"] or "")
        joined = brute.spans_text(base, pii.BASE_KINDS)
        x = got[r["doc_id"]]
        assert [x[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert x["base_sha256"] == brute.sha(joined)
        assert set(filter(None, joined.split(","))) <= set(x["spans"].split(","))


def test_private_query(spark, docs):
    check_private(docs.collect(), {r["doc_id"]: r for r in queries.op8_pii(spark, SF).collect()})


def test_private_awkward(spark, tmp_path):
    df = awkward(spark)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check_private(df.collect(), {r["doc_id"]: r for r in queries.op8_pii(spark, str(tmp_path)).collect()})
    assert pii.detect(empty(spark)).count() == 0


def test_labelers_are_weighed_and_the_classifier_adds_spans(spark):
    rows, want = [], {}
    for i in range(400):
        good = f"please call my phone 415-{200 + i % 700}-{1000 + i} now" if i % 2 else f"order no 115-{100 + i % 100}-{1000 + i} in stock"
        rows.append((i, good + f" mail user{i}@site.com"))
        want[i] = i % 2 == 1
    got = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    right = sum(any(s["kind"] == 3 and not s["base"] for s in got[i]) == want[i] for i in want)
    assert right >= 390
    assert all(any(s["base"] and s["kind"] == 0 for s in spans) for spans in got.values())


def test_adjacent_number_fields_keep_their_own_spans(spark):
    loose = lambda t: {(k, t[a:b]) for a, k, b in pii.loose_spans(t, pii.base_spans(t))}
    assert (5, "123-45-6789") in loose("SSN 123-45-6789 1990-01-02")
    assert {(5, "123-45-6789"), (3, "415-555-0132")} <= loose("123-45-6789 415-555-0132")
    assert (3, "415-555-0132") in loose("call 415-555-0132 2024")
    assert (5, "123-45-6789") in loose("id 10023 123-45-6789")
    assert loose("tel +1 (988) 555-2485") == set()
    body = next(x for n in range(10**11, 10**11 + 10_000) for x in [f"BE{98 - int(f'{n}111400') % 97:02d}{n}"] if luhn(x[2:]))
    iban = " ".join(body[k : k + 4] for k in range(0, 16, 4))
    assert [k for _, k, _ in pii.base_spans(iban)] == [2] and (4, iban) in loose(iban) and pii._by_pattern(4, iban, False) == pii.YES
    rows = [(i, f"SSN {100 + i}-45-{1000 + i} 1990-01-02 call 415-{200 + i}-{1000 + i} 2024") for i in range(400)]
    got = {r["doc_id"]: {(s["kind"], s["start"], s["end"]) for s in r["spans"]} for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum({(5, 4, 15), (3, 32, 44)} <= spans for spans in got.values()) >= 390


def test_overlaps_are_resolved_last_by_score():
    start, end, base = [0, 0, 5, 20, 22], [12, 6, 30, 25, 24], [False, False, False, True, False]
    assert pii.resolved([0.96, 0.95, 0.97, 0.1, 0.99], start, end, base) == [0.96, None, None, 0.1, 0.99]
    assert pii.resolved([0.5, 0.95, 0.89, 0.1, 0.99], start, end, base) == [None, 0.95, None, 0.1, 0.99]


def test_reliabilities_recover_a_known_mixture():
    import random

    rng, counts = random.Random(2), {}
    for _ in range(20000):
        truth = rng.random() < 0.6
        votes = [(1 if rng.random() < (a if truth else 1 - a) else 0) for a in (0.95, 0.8, 0.7)]
        code = votes[0] + 3 * votes[1] + 9 * votes[2]
        counts[0, code] = counts.get((0, code), 0) + 1
    p = pii.reliabilities(counts)
    assert p[0, 13] > 0.97 and p[0, 0] < 0.06
    assert p[0, 1] > p[0, 3 + 9] - 0.35  # the best labeler outweighs the others


def test_language_query_on_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in queries.op9_language_id(spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    right = total = 0
    for r in rows:
        x = got[r["doc_id"]]
        assert x["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= x["score"] <= 1
        if x["held_out"]:
            total += 1
            right += x["lang_pred"] == r["lang"]
    assert right >= 0.95 * total


def test_language_awkward(spark):
    df = awkward(spark)
    got = {r["doc_id"]: r for r in language_id.predict(df, language_id.learn(df)).collect()}
    for r in df.collect():
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (got[r["doc_id"]]["lang_pred"] == "und") == (not letters), r["text"]
    assert language_id.predict(empty(spark), language_id.learn(empty(spark))).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(df, language_id.learn(empty(spark))).collect()} == {"und"}


@pytest.mark.parametrize("stretch", [1, 2, 3, 64])
def test_forward_backward_against_all_paths(monkeypatch, stretch):
    import itertools

    import numpy as np

    monkeypatch.setattr(language_id, "STRETCH", stretch)
    rng = np.random.default_rng(3)
    sizes = np.array([3, 1, 5, 0, 2])
    score, trans, first = rng.normal(size=(11, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    prob, norm, expected = language_id.forward_backward(score, sizes, trans, first, pairs=True)
    want, pairs, log, at = np.zeros_like(score), np.zeros((3, 3)), 0.0, 0
    for n in sizes.tolist():
        total, own, two = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n) if n else ():
            w = np.exp(first[path[0]] + sum(score[at + t, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                own[t, y] += w
            for a, b in zip(path, path[1:]):
                two[a, b] += w
        if n:
            want[at : at + n], log = own / total, log + np.log(total)
            pairs += two / total
        at += n
    assert np.allclose(prob, want) and np.allclose(expected, pairs) and np.isclose(norm, log)


def test_words_of_switched_texts_get_their_own_language(spark, docs):
    model = language_id.learn(docs)
    rows = docs.filter("lang in ('en', 'de') and length(text) > 400").collect()
    en, de = (next(r["text"] for r in rows if r["lang"] == k and "|" not in r["text"]) for k in ("en", "de"))
    a, b = language_id.words_of(en)[:40], language_id.words_of(de)[:40]
    _, prob = language_id.label(language_id.Scorer(model), [" ".join(a + b)])
    best = [model.langs[k] for k in prob.argmax(1)]
    assert best[:40].count("en") >= 35 and best[40:].count("de") >= 35


def test_a_text_is_one_chain_however_its_lines_are_cut(spark, docs):
    import numpy as np

    model = language_id.learn(docs)
    assert np.abs(model.trans).max() > 0.1
    rows = docs.filter("lang in ('en', 'de') and length(text) > 400").collect()
    words = [w for k in ("en", "de") for w in language_id.words_of(next(r["text"] for r in rows if r["lang"] == k and "|" not in r["text"]))[:20]]
    (_, one), (_, cut) = (language_id.label(language_id.Scorer(model), [between.join(words)]) for between in (" ", "\n"))
    assert np.allclose(one, cut)


def test_grams_from_single_letters_to_affixes_of_three():
    _, owner = language_id.gram_ids(["abcd", "e"])
    assert [(owner == k).sum() for k in (0, 1)] == [6 + 5 + 4 + 3, 3 + 2 + 1]


def test_fixture_has_what_it_should():
    assert None in awkward_texts() and "" in awkward_texts()


def test_marks_go_on_with_a_word():
    assert language_id.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert language_id.words_of("ภาษาไทยนี้ กำลัง") == ["ภาษาไทยนี้", "กำลัง"]
    assert language_id.words_of("مُحَمَّد می\u200cخواهم 12 \u0301 \u0301abc e\u0301t\u0301") == ["مُحَمَّد", "می\u200cخواهم", "abc", "e\u0301t\u0301"]


def test_small_languages_keep_their_words_and_long_texts_teach(spark):
    many = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k // 26)}" for k in range(200)), "en") for i in range(400)]
    few = [(1000 + i, "xyzzy qwqwq zzyzx", "pt") for i in range(5)]
    counts = language_id.lexicon(spark.createDataFrame([(t, g) for _, t, g in many + few], "body string, lang string"), 300)
    assert {"xyzzy", "qwqwq", "zzyzx"} <= set(counts["word"]) and counts["word"].nunique() <= 300
    assert len(counts[counts["lang"] == "en"]) >= 100
    long = [(i, "uma casa muito grande e bonita. " * 800, "pt") for i in range(20)] + [(100 + i, f"the house number {i} is big", "en") for i in range(60)]
    docs = spark.createDataFrame(long, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    assert {got[i] for i in range(20)} == {"pt"} and {got[100 + i] for i in range(60)} == {"en"}
