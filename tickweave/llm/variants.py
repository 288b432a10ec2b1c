"""Spelling variants by FM-index search schemes over a delimited vocabulary.

Two words are near if they differ by one inserted, deleted or replaced code
point. Cut a word in two: the one error lies in one half, so a near word shares
the other half exactly, at the same end of the word. There are two searches.
The first matches the right half backwards from the closing delimiter and goes
on over the left half allowing one error; the second does the same on the
index of the reversed words, that is, it matches the left half forwards from
the opening delimiter and extends to the right. An FM-index for each direction
is all this takes: both halves touch a delimiter, so no search has to turn.
Matches are intervals of suffix ranks; a match that ends at the far delimiter
is an interval of delimiter ranks, and these number the sorted words.

An index covers the words of one batch. Rows are dealt by (direction, length of
the querying word, its exact half): each word is a query under its own length
and an entry under that length and its two neighbours, so a query meets every
word that its search could find. A bucket of more than ``BUCKET`` words is cut
again: its free region is halved, one half becomes exact as well, and so on.
Once one free code point is left, a bucket holds no more than a few times the
alphabet, so no bucket stays large and nothing is capped.

Defined results: null text has no words; a null id hashes as the empty text.
Repeated rows count again. Words of any code points and lengths are searched.
An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: One run in NOISE_MOD loses a code point (the contract's planted noise).
NOISE_MOD = 31
#: Words that may stay in one bucket, and words at which a task closes a batch.
BUCKET = 4096
BATCH = 60_000
PER_TASK = 200_000
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def noisy_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, one in ``NOISE_MOD`` without
    one code point; those long and frequent enough."""
    # a shorter run can't become long enough
    runs = F.regexp_extract_all(text_of(text), F.lit("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h, size = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.char_length("run")
    rows = rows.select("run", h.alias("h"), size.alias("size")).withColumn("cut", (F.col("h") % F.col("size")).cast("int"))
    cut = F.concat(F.substring("run", F.lit(1), F.col("cut")), F.substring("run", F.col("cut") + 2, F.col("size")))
    word = F.when(F.col("h") % NOISE_MOD == 0, cut).otherwise(F.col("run"))
    words = rows.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


class FMIndex:
    """Suffix ranks of sorted, distinct, non-empty words, each between delimiters.

    Symbol 0 is the delimiter, 1 stands before the first one, letters follow in
    code-point order. ``keys`` holds symbol * (rows + 1) + row for each row of
    the transform in order, so one binary search gives C[c] + rank(c, row)."""

    def __init__(self, words: list[str]):
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        alphabet, codes = np.unique(letters, return_inverse=True)
        self.words, self.size, self.letters = len(words), size, len(alphabet)
        self.start = np.cumsum(size + 1) - size  # of each word's first letter
        rows = len(letters) + len(words) + 1
        text = np.zeros(rows, dtype=np.int64)
        inside = np.ones(rows, dtype=bool)
        inside[np.concatenate(([0], self.start + size))] = False
        text[inside] = codes + 2
        self.text, self.rows = text, rows
        order = self._suffixes(inside)
        self.bwt = np.where(order == 0, 1, text[order - 1])
        by = np.argsort(self.bwt, kind="stable")
        self.keys = self.bwt[by] * (rows + 1) + by
        self.lf = np.empty(rows, dtype=np.int64)
        self.lf[by] = np.arange(rows)

    def _suffixes(self, inside: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in order; a suffix ends at its delimiter, ties go by position."""
        text, rows = self.text, self.rows
        ends = np.flatnonzero(~inside)
        left = ends[np.searchsorted(ends, np.arange(rows))] - np.arange(rows)  # letters before the delimiter
        bits = int(self.letters + 1).bit_length()
        width = 62 // bits
        key = text.copy()
        for k in range(1, width):
            key <<= bits
            more = np.flatnonzero(left >= k)
            key[more] |= text[more + k]
        while True:
            order = np.argsort(key, kind="stable")
            new = np.diff(key[order], prepend=-1) != 0
            rank = np.empty(rows, dtype=np.int64)
            rank[order] = np.cumsum(new)
            tied = ~new
            tied[:-1] |= tied[1:]
            if not (left[order[tied]] >= width).any():
                return order
            open_ = np.flatnonzero(left >= width)
            key = rank * (rows + 1)
            key[open_] += rank[open_ + width]
            width *= 2

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals with the symbol ``c`` set before each, and which of them are not empty."""
        new_lo, new_hi = self.lf[lo], np.empty_like(hi)
        there = self.bwt[lo] == c
        np.add(new_lo, 1, out=new_hi)
        wide = np.flatnonzero(hi - lo > 1)
        base = c[wide] * (self.rows + 1)
        new_lo[wide] = np.searchsorted(self.keys, base + lo[wide])
        new_hi[wide] = np.searchsorted(self.keys, base + hi[wide])
        there[wide] = new_hi[wide] > new_lo[wide]
        return new_lo, new_hi, there

    def before(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """All letters that stand before the intervals: (interval, letter, lo, hi) of each."""
        width = hi - lo
        wide = np.flatnonzero(width > 2 * self.letters)
        some = np.flatnonzero(width <= 2 * self.letters)
        n = width[some]
        row = np.repeat(lo[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        key = np.repeat(some, n) * (self.letters + 2) + self.bwt[row]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        owner, c = np.divmod(key[first], self.letters + 2)
        out = [(owner, c, self.lf[row[first]], self.lf[row[first]] + count)]
        if len(wide):
            owner, c = np.repeat(wide, self.letters), np.tile(np.arange(2, self.letters + 2), len(wide))
            base = c * (self.rows + 1)
            out.append((owner, c, np.searchsorted(self.keys, base + lo[owner]), np.searchsorted(self.keys, base + hi[owner])))
        owner, c, lo, hi = (np.concatenate(x) for x in zip(*out))
        keep = (c > 1) & (hi > lo)
        return owner[keep], c[keep], lo[keep], hi[keep]

    def one_error(self, q: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of the words one error away from word ``q``
        that share its first ``head`` and last ``tail`` code points."""
        size, at = self.size[q], self.start[q]
        by_size = np.argsort(-size, kind="stable")
        begun = 0
        none = np.empty(0, dtype=np.int64)
        z = (none, none, none)  # query, lo, hi without an error so far
        e = (none, none, none)  # with the error behind
        most = 16 * len(q) + 1000
        for p in range(int(size.max(initial=0)), -1, -1):  # letters still to be matched
            upto = int(np.searchsorted(-size[by_size], -p, side="right"))
            new = by_size[begun:upto]
            begun = upto
            z = tuple(map(np.concatenate, zip(z, (new, np.zeros_like(new), np.full_like(new, self.words + 1)))))
            gap = np.flatnonzero((head[z[0]] <= p) & (p <= size[z[0]] - tail[z[0]]))
            own, c, lo, hi = self.before(z[1][gap], z[2][gap])
            own = gap[own]
            e = tuple(map(np.concatenate, zip(e, (z[0][own], lo, hi))))  # a letter more in the word
            if p == 0:
                break
            lo1, hi1, there = self.step(self.text[at[e[0]] + p - 1], e[1], e[2])
            e = (e[0][there], lo1[there], hi1[there])
            free = (head[z[0]] <= p - 1) & (p - 1 < size[z[0]] - tail[z[0]])
            letter = self.text[at[z[0]] + p - 1]
            other = free[own] & (c != letter[own])
            e = tuple(map(np.concatenate, zip(e, (z[0][own[other]], lo[other], hi[other]), tuple(x[free] for x in z))))  # another letter; a letter less
            lo1, hi1, there = self.step(letter, z[1], z[2])
            there &= head[z[0]] <= p - 1
            z = (z[0][there], lo1[there], hi1[there])
            if len(e[0]) > most:
                e = _distinct(e)
                most = max(most, 2 * len(e[0]))
        lo1, _, there = self.step(np.zeros_like(e[0]), e[1], e[2])
        return _distinct((q[e[0][there]], lo1[there]))


def _distinct(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    order = np.lexsort(columns[::-1])
    columns = tuple(x[order] for x in columns)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return tuple(x[new] for x in columns)


def _pairs_of(batch: pd.DataFrame) -> pd.DataFrame:
    """(word, near, near_n) for the queries of one batch of whole buckets."""
    out = []
    for side, rows in batch.groupby("side"):
        turn = (lambda w: w[::-1]) if side else (lambda w: w)
        count = {turn(w): n for w, n in zip(rows["word"], rows["n"])}
        words = sorted(count)
        number = {w: i for i, w in enumerate(words)}
        ask = rows[rows["asks"]]
        q = np.fromiter((number[turn(w)] for w in ask["word"]), dtype=np.int64, count=len(ask))
        a, b = FMIndex(words).one_error(q, ask["head"].to_numpy(np.int64), ask["tail"].to_numpy(np.int64))
        found = [words[i] for i in b.tolist()]
        out += zip((turn(words[i]) for i in a.tolist()), map(turn, found), (count[w] for w in found))
    kinds = {"word": object, "near": object, "near_n": "int64"}  # also where nothing is found
    return pd.DataFrame(out, columns=list(kinds)).astype(kinds)


def _search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket. A batch closes where a bucket ends, so it holds ``BATCH`` rows and one bucket more at most."""
    held: list[pd.DataFrame] = []
    n = 0

    def batch(rows: pd.DataFrame) -> pd.DataFrame:
        by = rows.groupby("key", sort=False)["asks"]
        return _pairs_of(rows[(by.transform("size").to_numpy() > 1) & by.transform("any").to_numpy()])

    for frame in frames:
        held.append(frame)
        n += len(frame)
        if n >= BATCH:
            rows = pd.concat(held, ignore_index=True)
            last = rows["key"].to_numpy() == rows["key"].iloc[-1]
            held, n = [rows[last]], int(last.sum())
            if not last.all():
                yield batch(rows[~last])
    if held:
        yield batch(pd.concat(held, ignore_index=True))


def _reach(rows: DataFrame) -> DataFrame:
    """``rows`` with their bucket. head and tail count the exact code points at
    either end of the word as its direction reads it; side 1 reads it reversed."""
    front = F.when(F.col("side") == 0, F.col("head")).otherwise(F.col("tail"))
    back = F.when(F.col("side") == 0, F.col("tail")).otherwise(F.col("head"))
    # two buckets that hash alike are searched as one, which finds nothing else
    return rows.withColumn("key", F.xxhash64("side", "size", "head", "tail", F.left("word", front), F.right("word", back)))


def buckets(words: DataFrame) -> DataFrame:
    """Six rows a word: two directions by the lengths of the queries that may find it."""
    size = F.char_length("word")
    half = lambda side: F.col("size") - F.floor(F.col("size") / 2).cast("int") if side == 0 else F.floor(F.col("size") / 2).cast("int")
    rows = words.select("word", "n", F.explode(F.array(size - 1, size, size + 1)).alias("size")).filter("size > 0")
    rows = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"), F.lit(0).alias("head"))
    rows = rows.withColumn("tail", F.when(F.col("side") == 0, half(0)).otherwise(half(1))).withColumn("asks", F.char_length("word") == F.col("size"))
    return _reach(rows)


def _finer(rows: DataFrame) -> DataFrame:
    """Each row twice: with either half of its free region exact as well."""
    free = F.col("size") - F.col("head") - F.col("tail")
    half = F.floor(free / 2).cast("int")
    both = F.array(
        F.struct(F.col("head").alias("head"), (F.col("tail") + free - half).alias("tail")),
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")))
    rows = rows.withColumn("cut", F.explode(both)).withColumn("head", F.col("cut.head")).withColumn("tail", F.col("cut.tail"))
    return _reach(rows.drop("cut"))


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(word, near, near_n) of all pairs of near words, each at least once.
    ``words`` (word, n) is a written table of distinct words."""
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 6 * words.count() // PER_TASK + 1)
    rows, found = buckets(words), []
    while True:
        free = F.col("size") - F.col("head") - F.col("tail")
        hot, _ = written(rows.filter(free > 1).groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > bucket).select("key"), "hot-buckets")
        last = hot.isEmpty()
        here = rows if last else rows.join(hot, "key", "left_anti")
        here = here.select("key", "side", "asks", "head", "tail", "word", "n").repartition(tasks, "key").sortWithinPartitions("key")
        found.append(written(here.mapInPandas(_search, "word string, near string, near_n long"), "near-words")[0])
        if last:
            break
        rows, _ = written(_finer(rows.join(hot, "key", "left_semi")), "finer-buckets")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, root: its form). Each round
    doubles the steps taken; counts grow ``RATIO`` times a step, so chains are short."""
    while True:
        up = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, _ = written(forms.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        forms = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return forms


def group_variants(words: DataFrame, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the written table
    ``words`` (word, n). ``form`` is the near word of largest n (the smallest
    of several) if that is ``ratio`` times the word's n, ``root`` the last form
    reached from the word."""
    pairs = near_pairs(words, bucket).repartition("word").groupBy("word", "near").agg(F.max("near_n").alias("near_n"))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = words.join(best, "word", "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    rows, _ = written(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "variant-forms")
    ends = roots(rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
