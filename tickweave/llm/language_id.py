"""Language of words and texts by a linear-chain conditional random field.

The words of a text are a chain with one label, a language, each; the chains
learned from are the lines of labelled texts. A word's
score for a language sums hashed character n-grams (those at its ends are its
affixes) and its share in a lexicon; learned transitions join neighbours.
Forward-backward gives every word's probabilities; the text's language is the
one with the largest share of its words, the share is the score.

The lexicon counts the words of all texts learned from, by language; the most
frequent ones of each language, at most ``LEXICON`` in equal parts, are
broadcast. At most ``LANGS`` languages are learned, those of the most labelled
texts. The field is fitted on the driver on at most ``TRAIN_DOCS`` labelled
texts a language, chosen by a hash of their ids; of a text of more than
``TRAIN_CHARS`` characters it takes as many from a place that the hash gives. Prediction reads whole texts
without a shuffle: each distinct word of a task is scored once, and the chains
of a block of texts step forward together.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is everything if no language can be learned. Ties go to the language
first in order. Null and repeated ids are rows like others (a null id counts as
the empty text in the fold). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written

FOLDS, HELD_OUT = 4, 2
LEXICON = 20_000
#: Languages that are learned: the most frequent labels.
LANGS = 64
TRAIN_DOCS = 200
TRAIN_CHARS = 20_000
BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
ROUNDS = 30
#: Distinct (word, language) counts that a task holds before it passes them on.
HELD = 500_000
#: Characters of text whose words are scored together, and scores of distinct words that a task keeps.
BLOCK = 4_000_000
KEPT = 2_400_000
#: Words of a chain that are stepped through one after the other.
STRETCH = 256
BEGIN, STOP = "\x02", "\x03"
#: What goes on with a word beside letters: marks (vowel signs, accents) and the two joiners.
JOINED = r"\p{M}\x{200C}\x{200D}"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


class Words:
    """The letter words of texts, lower-cased, as codes into the distinct ones,
    with how many there are in each line and each text."""

    def __init__(self, texts: list[str]):
        low = pc.utf8_lower(pa.array(texts, pa.string()))
        lines = pc.replace_substring(pc.replace_substring_regex(low, rf"[^\p{{L}}{JOINED}\n]+", " "), "\n", " \n ")
        lines = pc.replace_substring_regex(lines, f"(^| )[{JOINED}]+", r"\1")  # a word begins with a letter
        lists = pc.split_pattern(lines, " ")
        coded = lists.flatten().dictionary_encode()
        code, self.distinct = coded.indices.to_numpy(), coded.dictionary
        line_end, nothing = (pc.index(self.distinct, x).as_py() for x in ("\n", ""))
        begins = lists.offsets.to_numpy()
        starts = code == line_end
        starts[begins[:-1][begins[:-1] < len(code)]] = True
        word = (code != line_end) & (code != nothing)
        sizes = np.bincount(np.cumsum(starts)[word]) if len(code) else np.zeros(0, dtype=np.int64)
        #: code of each word, words of each line, words of each text
        self.code, self.sizes = code[word], sizes[sizes > 0]
        ends = np.concatenate(([0], np.cumsum(word)))[begins]
        self.by_text = ends[1:] - ends[:-1]


def words_of(text: str) -> list[str]:
    w = Words([text])
    return w.distinct.take(pa.array(w.code)).to_pylist()


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in blocks of about BLOCK characters, each with its first position."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK or k == len(texts) - 1:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0


def lexicon(rows: DataFrame, size: int = LEXICON) -> pd.DataFrame:
    """The most frequent words of each language in ``rows`` (body, lang) with their counts in all of them."""
    kinds = pa.schema([("word", pa.string()), ("lang", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["word", "lang"]).aggregate([("n", "sum")]).rename_columns(["word", "lang", "n"]).cast(kinds)

        for b in batches:
            langs = b.column("lang").to_pylist()
            bodies = b.column("body").to_pylist()
            for lang in sorted(set(langs)):
                for _, texts in blocks([t for t, x in zip(bodies, langs) if x == lang]):
                    w = Words(texts)
                    n = np.bincount(w.code, minlength=len(w.distinct))
                    there = pa.array(n > 0)
                    words = w.distinct.filter(there)
                    held.append(pa.table([words, pa.array([lang] * len(words), pa.string()), pa.array(n[n > 0], pa.int64())], schema=kinds))
            if sum(map(len, held)) > HELD:
                held = [merged()]
                if len(held[0]) > HELD:
                    yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    counts = rows.mapInArrow(count, "word string, lang string, n long")
    by_word = counts.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    by_word, _ = written(by_word, "lexicon")
    # from which band on (an eighth of a doubling) a language has its part, then the part itself by rank
    part = max(1, size // max(1, by_word.select("lang").distinct().count()))
    band = F.floor(8 * F.log2("n")).cast("int")
    bands = by_word.groupBy("lang", band.alias("band")).agg(F.count(F.lit(1)).alias("words"))  # at most 504 rows a language
    above = F.sum("words").over(Window.partitionBy("lang").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1))
    least = bands.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < part).groupBy("lang").agg(F.min("band").alias("least"))
    few = by_word.join(F.broadcast(least), "lang").filter(band >= F.col("least"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = few.withColumn("nth", nth).filter(F.col("nth") <= part).select("word").distinct()
    return by_word.join(top, "word", "left_semi").toPandas()  # at most ``size`` words


def gram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the words with their ends marked, and the word it belongs to."""
    joined = "".join([f"{BEGIN}{w}{STOP}" for w in words])
    code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters to the word's end
    buckets, owners = [], []
    for n in GRAMS:
        ok = np.flatnonzero(left >= n)
        h = np.full(len(ok), n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ code[ok + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        buckets.append((h % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(word[ok])
    return np.concatenate(buckets), np.concatenate(owners)


class Model:
    """Weights, and the lexicon as log shares."""

    def __init__(self, langs: list[str], counts: pd.DataFrame):
        self.langs = langs
        k = len(langs)
        self.grams, self.lex = np.zeros((BUCKETS, k)), np.zeros((k, k))
        self.trans, self.first = np.zeros((k, k)), np.zeros(k)
        self.words: dict[str, int] = {}
        table = np.full((counts["word"].nunique() + 1, k), 0.5)
        column = {lang: i for i, lang in enumerate(langs)}
        for word, lang, n in counts.itertuples(index=False):
            table[self.words.setdefault(word, len(self.words) + 1), column[lang]] += n
        table[0] = 1.0
        totals = table[1:].sum(0) if len(table) > 1 else np.ones(k)
        share = table / totals
        share[0] = 1.0
        self.shares = np.log(share / share.sum(1, keepdims=True)) + np.log(max(k, 1))

    def shares_of(self, words: list[str]) -> np.ndarray:
        return self.shares[np.fromiter((self.words.get(w, 0) for w in words), dtype=np.int64, count=len(words))]

    def scores(self, words: list[str]) -> np.ndarray:
        """Each distinct word's score for each language."""
        if not words:
            return np.zeros((0, len(self.langs)))
        bucket, owner = gram_ids(words)
        out = np.stack([np.bincount(owner, self.grams[bucket, j], len(words)) for j in range(len(self.langs))], axis=1)
        return out + self.shares_of(words) @ self.lex


def _unit(a: np.ndarray) -> np.ndarray:
    return a / a.sum(axis=-1, keepdims=True)


def forward_backward(score: np.ndarray, sizes: np.ndarray, trans: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Word probabilities of chains laid end to end, the sum of their log
    normalisers, and expected transitions if asked for.

    Chains are cut into stretches of STRETCH words that step together. What a
    stretch does to the probabilities before it is a small matrix; multiplied
    along each chain, these give every stretch its exact start and end, so the
    steps do not grow with the longest chain."""
    sizes = sizes[sizes > 0]
    k = score.shape[1]
    if not len(sizes):
        return np.zeros((0, k)), 0.0, np.zeros((k, k))
    top = score.max(axis=1, keepdims=True)
    e, m, f = np.exp(score - top), np.exp(trans), np.exp(first - first.max())
    begins = np.cumsum(sizes) - sizes
    parts = -(-sizes // STRETCH)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(begins, parts) + nth * STRETCH
    size = np.minimum(STRETCH, np.repeat(begins + sizes, parts) - start)

    def together(of: np.ndarray):
        """Those stretches longest first, and how many have a step t."""
        order = of[np.argsort(-size[of], kind="stable")]
        longest = int(size[order[0]]) if len(order) else 0
        return order, np.searchsorted(-size[order], -np.arange(longest), side="left")

    before, after = np.ones((len(start), k)), np.ones((len(start), k))  # probabilities entering, weights leaving
    long = np.flatnonzero(np.repeat(parts, parts) > 1)
    if len(long):
        effect = np.repeat(np.eye(k)[None], len(start), axis=0)
        order, live = together(long)
        for t in range(len(live)):
            s, at = order[: live[t]], start[order[: live[t]]] + t
            step = effect[s] @ m * e[at][:, None, :]
            if t == 0:  # a chain's first word has no word before it
                step[nth[s] == 0] = np.eye(k) * (f * e[at[nth[s] == 0]])[:, None, :]
            effect[s] = step / step.sum(axis=(1, 2), keepdims=True)
        for j in range(1, int(parts.max())):
            s = long[nth[long] == j]
            before[s] = _unit((before[s - 1][:, None, :] @ effect[s - 1])[:, 0])
        for j in range(int(parts.max()) - 1, 0, -1):
            s = long[nth[long] == j]
            w = (effect[s] @ after[s][:, :, None])[:, :, 0]
            after[s - 1] = w / (before[s] * w).sum(1, keepdims=True)
    alpha, scale, beta = np.empty_like(e), np.empty(len(e)), np.empty_like(e)
    order, live = together(np.arange(len(start)))
    opening = nth[order] == 0
    for t in range(len(live)):
        at = start[order[: live[t]]] + t
        if t:
            a = alpha[at - 1] @ m * e[at]
        else:
            a = np.where(opening[:, None], f, before[order] @ m) * e[at]
        s = a.sum(1)
        alpha[at], scale[at] = a / s[:, None], s
    ends = start + size - 1
    beta[ends] = after
    beta[ends] /= (alpha[ends] * beta[ends]).sum(1, keepdims=True)
    for t in range(len(live) - 2, -1, -1):
        at = start[order[: live[t + 1]]] + t
        beta[at] = (e[at + 1] * beta[at + 1] / scale[at + 1][:, None]) @ m.T
    expected = np.zeros_like(m)
    if pairs:
        inner = np.ones(len(e), dtype=bool)
        inner[begins] = False
        at = np.flatnonzero(inner)
        expected = m * (alpha[at - 1].T @ (e[at] * beta[at] / scale[at][:, None]))
    return alpha * beta, np.log(scale).sum() + top.sum() + first.max() * len(sizes), expected


def fit(rows: list[tuple[str, str]], langs: list[str], counts: pd.DataFrame, rounds: int = ROUNDS) -> Model:
    """Maximum likelihood with a quadratic penalty by adaptive gradient steps;
    a chain is a line of a text, its labels the text's language."""
    model, k = Model(langs, counts), len(langs)
    words = Words([text for text, _ in rows])
    if not len(words.code) or k < 2:
        return model
    used, word = np.unique(words.code, return_inverse=True)
    distinct = words.distinct.take(pa.array(used)).to_pylist()
    label = np.repeat([langs.index(lang) for _, lang in rows], words.by_text)
    sizes = words.sizes
    begins = np.cumsum(sizes) - sizes
    bucket, owner = gram_ids(distinct)
    shares = model.shares_of(distinct)
    gold = np.zeros((len(word), k))
    gold[np.arange(len(word)), label] = 1
    inner = np.ones(len(word), dtype=bool)
    inner[begins] = False
    stays = np.diag(np.bincount(label[inner], minlength=k).astype(float))
    n = len(word)
    weights = [model.grams, model.lex, model.trans, model.first]
    seen = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(rounds):
        own = np.stack([np.bincount(owner, model.grams[bucket, j], len(distinct)) for j in range(k)], axis=1) + shares @ model.lex
        prob, _, expected = forward_backward(own[word], sizes, model.trans, model.first, pairs=True)
        off = prob - gold
        by_word = np.stack([np.bincount(word, off[:, j], len(distinct)) for j in range(k)], axis=1)
        grads = [np.stack([np.bincount(bucket, by_word[owner, j], BUCKETS) for j in range(k)], axis=1), shares.T @ by_word, expected - stays, off[begins].sum(0)]
        for w, s, g, keep in zip(weights, seen, grads, (1e-6, 1e-4, 1e-3, 1e-3)):
            g = g / n + keep * w
            s += g * g
            w -= 0.3 * g / np.sqrt(s)
    return model


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the labelled texts outside the held-out fold."""
    rows = docs.filter(~held_out(doc_id) & F.col(lang).isNotNull()).select(
        F.col(doc_id).cast("string").alias("id"), text_of(text).alias("body"), F.col(lang).cast("string").alias("lang"))
    many = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGS)
    many, _ = written(many.select("lang"), "languages")
    rows = rows.join(F.broadcast(many), "lang", "left_semi")  # at most LANGS rows
    counts = lexicon(rows.select("body", "lang"))
    chars = F.char_length("body")
    at = F.when(chars > TRAIN_CHARS, F.pmod(F.xxhash64("id"), chars - TRAIN_CHARS)).otherwise(0).cast("int")
    short = rows.filter(chars > 0).select("id", "lang", F.substring("body", at + 1, F.lit(TRAIN_CHARS)).alias("body"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    picked = short.select("id", "lang", F.xxhash64("id").alias("order")).withColumn("nth", nth).filter(F.col("nth") <= TRAIN_DOCS).select("id", "lang")
    picked, _ = written(picked.distinct(), "language-sample")
    sample = short.join(F.broadcast(picked), ["id", "lang"], "left_semi").select("body", "lang").distinct()  # TRAIN_DOCS ids a language
    found = sorted({(r["body"], r["lang"]) for r in sample.collect()})
    langs = sorted({lang for _, lang in found} | set(counts["lang"]))
    return fit(found, langs, counts)


class Scorer:
    """Scores each distinct word of a task once (up to KEPT scores)."""

    def __init__(self, model: Model):
        self.model = model
        self.words = pa.array([], pa.string())
        self.scores = np.zeros((0, len(model.langs)))

    def of(self, words: pa.Array) -> np.ndarray:
        if self.scores.size > KEPT:
            self.__init__(self.model)
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            new = words.filter(at.is_null())
            at = pc.replace_with_mask(at, at.is_null(), pa.array(np.arange(len(self.words), len(self.words) + len(new), dtype=np.int32)))
            self.words = pa.concat_arrays([self.words, new])
            self.scores = np.concatenate([self.scores, self.model.scores(new.to_pylist())])
        return self.scores[at.to_numpy()]


def label(scorer: Scorer, texts: list[str]) -> tuple[Words, np.ndarray]:
    """The words of the texts and each one's probabilities."""
    words = Words(texts)
    prob, _, _ = forward_backward(scorer.of(words.distinct)[words.code], words.by_text, scorer.model.trans, scorer.model.first)
    return words, prob


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) of every text."""
    if len(model.langs) == 0:
        zero = F.lit(0).cast("long")
        return docs.select(F.col(doc_id).alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), zero.alias("n_words"), zero.alias("n_switches"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, n_words long, n_switches long")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for texts in frames:
            parts = [summed(scorer, block) for _, block in blocks(texts.tolist())]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": [], "score": [], "n_words": [], "n_switches": []})

    return docs.select(F.col(doc_id).alias("doc_id"), run(text_of(text)).alias("x")).select("doc_id", "x.*")


def summed(scorer: Scorer, texts: list[str]) -> pd.DataFrame:
    """Language, score, words and changes of language of each text."""
    words, prob = label(scorer, texts)
    n, langs = words.by_text, np.array([*scorer.model.langs, "und"], dtype=object)
    some = n > 0
    top, score, switches = np.full(len(n), len(langs) - 1), np.zeros(len(n)), np.zeros(len(n), dtype=np.int64)
    if some.any():
        begins = (np.cumsum(n) - n)[some]
        share = np.add.reduceat(prob, begins, axis=0) / n[some][:, None]
        top[some], score[some] = share.argmax(1), np.minimum(share.max(1), 1.0)
        best = prob.argmax(1)
        change = np.concatenate(([False], best[1:] != best[:-1]))
        change[begins] = False
        switches[some] = np.add.reduceat(change.astype(np.int64), begins)
    return pd.DataFrame({"lang_pred": langs[top], "score": score, "n_words": n.astype(np.int64), "n_switches": switches})
