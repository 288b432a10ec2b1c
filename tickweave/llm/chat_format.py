"""Chat formatting by incremental rendering of a black-box template.

A template is a function from the turns so far to text. The turns of a
conversation are rendered one prefix at a time; what a render adds to the one
before is the new turn's span. Two probe texts in the new turn's place tell the
marks around it from its text, and so where the loss mask lies. A render that
doesn't begin with the one before shows a template that rewrites history; the
conversation then gets the number of that turn and no spans.

Rows meet by conversation in one sorted shuffle and stream through; a task
holds one conversation at a time (one output text is its result).

The template here marks turns and escapes control strings reversibly: a
backslash goes between ``<`` and ``|``, behind those already there, so no text
holds ``<|``; line ends and backslashes in roles are escaped as well.

Defined results: null text and null role are empty; null turns come first, ties
are ordered by role, then text; rows of a null conversation form one. Repeated
rows are turns like others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
PROBES = ("x", "y")
SPAN = "struct<start:long,loss_start:long,loss_end:long,end:long>"
Turn = tuple[str, str]


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "<" in text else text


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[Turn]) -> str:
    return "".join([f"{START}{_escape_role(r)}\n{escape(t)}{END}\n" for r, t in turns])


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that ``render`` made."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        out.append((_unescape_role(role), unescape(rest[: rest.rindex(END)])))
    return out


def _same(a: str, b: str) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(turns: list[Turn], template: Callable[[list[Turn]], str], roles: tuple[str, ...] = LOSS_ROLES) -> tuple[str, list[dict] | None, int | None]:
    """The formatted text, each turn's span, and the first turn that rewrites
    history (then there are no spans)."""
    before, spans, rewritten = template([]), [], None
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            rewritten = k if rewritten is None else rewritten
        span = {"start": len(before), "loss_start": None, "loss_end": None, "end": len(now)}
        if role in roles and rewritten is None:
            one, two = (template([*turns[:k], (role, p)])[len(before) :] for p in PROBES)
            head, tail = _same(one, two), _same(one[::-1], two[::-1])
            span |= {"loss_start": len(before) + head, "loss_end": len(now) - tail}
        spans.append(span)
        before = now
    return before, spans if rewritten is None else None, rewritten


def _conversations(batches) -> Iterator[tuple[object, list[Turn]]]:
    """Sorted rows as conversations; one may run over from one batch to the next."""
    key, turns = None, []
    for b in batches:
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if turns and conv != key:
                yield key, turns
                turns = []
            key = conv
            turns.append((role, text))
    if turns:
        yield key, turns


def _map(rows: DataFrame, of: Callable, schema: str) -> DataFrame:
    """``of(conv_id, turns)`` for each conversation."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = rows.schema["conv_id"].dataType.simpleString()
    full = f"conv_id {kind}, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(full))

    def run(batches):
        out, size = [], 0
        for conv, turns in _conversations(batches):
            out.append(dict(zip(arrow.names, (conv, *of(turns)))))
            size += sum(len(t) for _, t in turns)
            if len(out) >= 1000 or size > 8_000_000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return (rows.select("conv_id", "turn", text("role"), text("text")).repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, full))


def format_conversations(rows: DataFrame, template: Callable[[list[Turn]], str] = render, roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, spans, rewritten_at) of rows with conv_id, turn, role, text."""
    return _map(rows, lambda turns: locate(turns, template, roles), f"formatted string, spans array<{SPAN}>, rewritten_at int")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and their loss masks hold when read back. A
    conversation whose template rewrites history has no spans: all but its
    length is null."""
    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def back(texts: pd.Series, masks: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, masks):
            if spans is None:
                out.append((None, None, None, None, len(text)))
                continue
            turns = read_back(text)
            loss = "".join(unescape(text[s["loss_start"] : s["loss_end"]]) for s in spans)
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
        columns = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pd.DataFrame(out, columns=columns).astype({"n_turns": "Int64", "loss_chars": "Int64"})

    masks = F.filter("spans", lambda s: s["loss_start"].isNotNull())
    return formatted.withColumn("back", back("formatted", masks)).select("conv_id", "back.*", F.col("rewritten_at").isNotNull().alias("rewrites_history"))
