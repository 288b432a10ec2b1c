"""Personal data by weak supervision.

Candidate spans come from strict patterns (the base kinds) and looser ones.
Three labelers vote yes, no or nothing on each: the pattern's own checks, a
gazetteer (endings, prefixes, names) and the words around. How often each
combination of votes occurs, counted over all documents, is all that
expectation-maximisation needs to estimate how reliable each labeler is for
each kind. The resulting probabilities label a sample of about
``TRAIN_SPANS`` spans, on which a logistic span classifier is trained; it then
decides on every candidate beyond the base ones, which always stay. Candidates
may overlap; where accepted ones do, those of higher score stay, beside any base
spans (a loose candidate within a base span of its own kind is that span).

Texts are read once and never shuffled: what later steps need of a document is
its candidates. Vote counts are at most kinds times 27 rows; the classifier has
``FEATURES`` weights.

Defined results: null text is the empty text. Where there are no candidates to
learn from, only base spans are returned. Null and repeated ids are rows like
others. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "name")
NO, YES, NONE = 0, 1, 2
#: Spans that the classifier is trained on: about so many, or all if there are fewer.
TRAIN_SPANS = 20_000
SHARES = 1 << 40
FEATURES = 1 << 12
ACCEPT = 0.9
ROUNDS = 60
#: Characters on either side that the context labeler reads.
AROUND = 32

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Looser candidates by kind.
LOOSE = (
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z]{2,24})+")),
    (3, re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    (4, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    (6, re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})?")),
)
# Fixed lists of the gazetteer labeler.
TLDS = frozenset("com org net edu gov info io de fr es it uk eu ch at nl be pl se us ca au jp".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
ISSUERS = ("4", "34", "37", "51", "52", "53", "54", "55", "6011", "62", "65")
IBAN_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
GIVEN = frozenset("""anna anne carlos charles claire david elena emma eva frank hans james jean john jose juan julia karl laura louis luis
    maria marie mark martin mary michael paul peter pierre robert sarah sofia susan thomas william""".split())
CUES = {
    0: ("mail", "e-mail", "contact", "write to", "correo", "courriel"), 1: ("ip", "host", "address", "server", "login from"),
    2: ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"), 3: ("call", "phone", "tel", "mobile", "fax", "handy", "llama"),
    4: ("iban", "account", "konto", "compte", "cuenta"), 5: ("ssn", "social security"), 6: ("name", "dear", "signed", "hello", "hallo", "bonjour"),
}
COUNTERCUES = ("version", "isbn", "order no", "invoice", "serial", "build", "item no")
SPAN = "struct<start:long,kind:int,end:long,base:boolean,votes:int,features:array<int>>"


def luhn(digits: str) -> bool:
    return sum(int(d) if k % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for k, d in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Each at sign with the longest name before it and a domain behind it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All candidates that are not within a base span of their own kind."""
    found = [(m.start(), kind, m.end()) for kind, pattern in LOOSE for m in pattern.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19]
    same: dict[int, tuple[list[int], list[int]]] = {}
    for a, kind, b in base:
        starts, ends = same.setdefault(kind, ([], []))
        starts.append(a)
        ends.append(b)
    out = []
    for a, kind, b in sorted(found):
        starts, ends = same.get(kind, ((), ()))
        if not (k := bisect_right(starts, a)) or ends[k - 1] < b:
            out.append((a, kind, b))
    return out


def resolved(score: Sequence[float], start: Sequence[int], end: Sequence[int], base: Sequence[bool]) -> list[float | None]:
    """The scores of the spans that stay, None for the others: base spans, and
    the accepted ones that overlap no accepted one of higher score."""
    out: list[float | None] = [float(x) if b else None for x, b in zip(score, base)]
    starts: list[int] = []
    ends: list[int] = []
    for k in sorted((k for k, b in enumerate(base) if not b and score[k] >= ACCEPT), key=lambda k: (-score[k], start[k], k)):
        at = bisect_left(starts, start[k])
        if (at == 0 or ends[at - 1] <= start[k]) and (at == len(starts) or starts[at] >= end[k]):
            starts.insert(at, start[k])
            ends.insert(at, end[k])
            out[k] = float(score[k])
    return out


def _by_pattern(kind: int, span: str, base: bool) -> int:
    if base:
        return YES
    d = _digits(span)
    if kind == 2:
        return NO  # a card of the right length that fails its check digit
    if kind == 3:
        return YES if len(d) == 10 and d[0] not in "01" and d[3] not in "01" else NO
    if kind == 4:
        s = span.replace(" ", "")
        return YES if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 else NO
    if kind == 5:
        return NO if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else YES
    return YES if kind == 0 else NONE


def _by_gazetteer(kind: int, span: str) -> int:
    d = _digits(span)
    if kind == 0:
        return YES if re.split(r"[^A-Za-z]+", span.lower().rstrip(")]"))[-1] in TLDS else NO
    if kind == 1:
        return NO if span.startswith(("0.", "127.", "255.")) else YES
    if kind == 2:
        return YES if d.startswith(ISSUERS) else NO
    if kind == 3:
        return (YES if d.startswith(CALLING) else NO) if span[0] == "+" else NONE
    if kind == 4:
        return YES if span[:2] in IBAN_COUNTRIES else NO
    if kind == 6:
        return YES if any(w.lower() in GIVEN for w in span.split()[1:]) else NONE
    return NONE


def _by_context(kind: int, before: str, after: str) -> int:
    near = f"{before} {after}".lower()
    if any(c in near for c in COUNTERCUES):
        return NO
    return YES if any(re.search(rf"(?<![a-z]){re.escape(c)}", near) for c in CUES[kind]) else NONE


def _feature(*of: object) -> int:
    return zlib.crc32("|".join(map(str, of)).encode()) % FEATURES


def describe(text: str, start: int, kind: int, end: int, base: bool) -> dict:
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    votes = (_by_pattern(kind, span, base), _by_gazetteer(kind, span), _by_context(kind, before, after))
    shape = re.sub("[0-9]+", "9", re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", span[:40])))
    names = [("kind", kind), ("shape", kind, shape), ("length", kind, min(len(span), 40) // 4), ("digits", kind, len(_digits(span))),
             ("before", kind, before[-1:].isalnum()), ("after", kind, after[:1].isalnum())]
    names += [("vote", kind, k, v) for k, v in enumerate(votes)]
    names += [("word", kind, w.lower()) for w in re.findall(r"\w+", before)[-2:] + re.findall(r"\w+", after)[:2]]
    return {"start": start, "kind": kind, "end": end, "base": base, "votes": votes[0] + 3 * votes[1] + 9 * votes[2], "features": sorted({_feature(*n) for n in names})}


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): every document's candidates with votes and features."""

    def spans(t: str) -> list[dict]:
        base = base_spans(t)
        return [describe(t, *s, True) for s in base] + [describe(t, *s, False) for s in loose_spans(t, base)]

    @F.pandas_udf(f"array<{SPAN}>")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in frames:
            yield pd.Series([spans(t) for t in texts], dtype=object)

    return docs.select(F.col(doc_id).alias("doc_id"), run(text_of(text)).alias("spans"))


def reliabilities(counts: dict[tuple[int, int], int], rounds: int = ROUNDS) -> dict[tuple[int, int], float]:
    """By (kind, votes): the probability that such a span is personal data.
    Each labeler has, for either truth, a chance of yes, no and no vote."""
    out = {}
    for kind in sorted({k for k, _ in counts}):
        codes = sorted(v for k, v in counts if k == kind)
        n = np.array([counts[kind, v] for v in codes], dtype=float)
        votes = np.array([[v % 3, v // 3 % 3, v // 9] for v in codes])
        share = (votes == YES).sum(1) - (votes == NO).sum(1)
        p = np.clip(0.5 + 0.3 * share, 0.02, 0.98)
        for _ in range(rounds):
            prior = (p @ n + 1) / (n.sum() + 2)
            odds = np.log(prior / (1 - prior))
            for j in range(3):
                yes = np.array([(p * n)[votes[:, j] == v].sum() for v in range(3)]) + np.array([0.5, 2.0, 0.5])
                no = np.array([((1 - p) * n)[votes[:, j] == v].sum() for v in range(3)]) + np.array([2.0, 0.5, 0.5])
                odds = odds + np.log(yes / yes.sum())[votes[:, j]] - np.log(no / no.sum())[votes[:, j]]
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        out |= {(kind, v): float(x) for v, x in zip(codes, p)}
    return out


def train(rows: list[list[int]], labels: np.ndarray, rounds: int = 200, rate: float = 0.5) -> np.ndarray:
    """Logistic regression on sets of features and soft labels; the last weight is the intercept."""
    w, seen = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    if not rows:
        w[-1] = -30.0
        return w
    sizes = np.array([len(r) for r in rows])
    row, col = np.repeat(np.arange(len(rows)), sizes), np.array([x for r in rows for x in r])
    for _ in range(rounds):
        z = np.bincount(row, w[col], len(rows)) + w[-1]
        off = (1 / (1 + np.exp(-z)) - labels) / len(rows)
        g = np.append(np.bincount(col, off[row], FEATURES), off.sum())
        g[:-1] += 1e-5 * w[:-1]
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def fit(found: DataFrame) -> np.ndarray:
    """The classifier's weights from candidates (a written table)."""
    each = found.select("doc_id", F.explode("spans").alias("s"))
    counts = {(r["kind"], r["votes"]): r["n"] for r in each.groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    truth = reliabilities(counts)
    total = sum(counts.values())
    order = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "s.start", "s.kind"), F.lit(SHARES))
    share = SHARES * TRAIN_SPANS // max(total, TRAIN_SPANS)  # about TRAIN_SPANS of them, told by a hash
    sample = each.withColumn("order", order).filter(F.col("order") < share).select("order", "s.kind", "s.votes", "s.features").collect()
    sample = sorted(sample, key=lambda r: (r["order"], r["kind"], r["votes"], r["features"]))
    return train([list(r["features"]) for r in sample], np.array([truth[r["kind"], r["votes"]] for r in sample]))


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans array<start, kind, end, base, score>) of every document:
    base spans and those that the classifier accepts."""
    found, _ = written(candidates(docs, doc_id, text), "pii-candidates")
    weights = found.sparkSession.sparkContext.broadcast(fit(found))

    @F.pandas_udf("array<double>")
    def score(features: pd.Series, start: pd.Series, end: pd.Series, base: pd.Series) -> pd.Series:
        w = weights.value
        scores = ([float(1 / (1 + np.exp(-np.clip(w[np.asarray(f, dtype=int)].sum() + w[-1], -30, 30)))) for f in fs] for fs in features)
        return pd.Series([resolved(*x) for x in zip(scores, start, end, base)], dtype=object)

    part = lambda name: F.transform("spans", lambda s: s[name])
    scored = found.withColumn("score", score(part("features"), part("start"), part("end"), part("base")))
    whole = F.transform("spans", lambda s, k: F.struct(s["start"], s["kind"], s["end"], s["base"], F.get("score", k).alias("score")))
    return scored.select("doc_id", F.sort_array(F.filter(whole, lambda s: s["score"].isNotNull())).alias("spans"))
