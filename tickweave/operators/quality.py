"""Data-quality checks over stored bars (D5-D14, E1, E2, F2), all pairs in
one job.

Layout for scale: one pass. Identical rows collapse in an aggregate (combined
map-side, so copies never meet in one task); one window per (pair, UTC date)
looks at the row before; everything the report says about a day is folded
without a further shuffle; one window over pair-days finds the gaps that cross
midnight, and the days fold into pairs. The single-check queries read the same
day and pair tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import gap_has_open_probe, open_minutes_between
from ..functions.text import iso_utc
from .bars import ohlc_bad

EXAMPLES = 10          # first N examples of gaps and spikes (the feature's cap)
GAP_MINUTES = 5        # gaps over 5 minutes
SPIKE_RATIO = 0.05     # |open - prev close| / prev close > 5 %


def _order_cols(bars: DataFrame) -> list[str]:
    """Row order of the checks: time, then a deterministic tie-break for
    duplicate timestamps (earlier knowledge time, hash, values)."""
    return ["timestamp"] + [c for c in ("knowledge_time", "bar_hash", "open", "close") if c in bars.columns]


def _collapsed(bars: DataFrame) -> DataFrame:
    """Rows identical in every column the checks read collapse to one row with
    multiplicity ``_n``. This is an aggregate, so even a bar copied millions of
    times shrinks map-side; the window below then sees at most the distinct
    variants of a pair-day."""
    has_hash = "bar_hash" in bars.columns
    return bars.withColumn("_d", F.to_date("timestamp")).groupBy("pair", "_d", *_order_cols(bars), "source").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(ohlc_bad(with_volume=False)).alias("_bad"),
        F.count_if(F.coalesce(F.nanvl("volume", F.lit(None).cast("double")) <= 0, F.lit(False))).alias("_zero"),
        (F.count_if(F.col("bar_hash").isNull()) if has_hash else F.lit(0).cast("bigint")).alias("_nohash"),
    )


def lagged_rows(bars: DataFrame) -> DataFrame:
    """One window pass per (pair, date) over the collapsed rows: previous
    distinct row's timestamp and close, plus the row's own order key."""
    order = _order_cols(bars)
    w = Window.partitionBy("pair", "_d").orderBy(*[F.col(c).asc_nulls_last() for c in [*order, "source"]])
    return _collapsed(bars).select(
        "pair", "_d", "timestamp", "open", "close", "source", "_n", "_bad", "_zero", "_nohash",
        F.struct(*[F.col(c) for c in order]).alias("_k"),
        F.lag("timestamp").over(w).alias("prev_ts"),
        F.lag("close").over(w).alias("prev_close"),
    )


def _gap(prev: Column, ts: Column, strict: bool) -> Column:
    """The step from ``prev`` to ``ts`` as a gap struct, NULL if not reported."""
    if strict:  # any gap over 5 minutes that contains an open minute
        minute = F.expr("INTERVAL 1 MINUTE")
        open_inside = open_minutes_between(prev + minute, ts - minute) > 0
    else:
        open_inside = gap_has_open_probe(prev, ts)
    long = ts > prev + F.expr(f"INTERVAL {GAP_MINUTES} MINUTES")
    return F.when(prev.isNotNull() & long & open_inside, F.struct(
        prev.alias("from_ts"), ts.alias("to_ts"),
        ((F.unix_micros(ts) - F.unix_micros(prev)) / F.lit(60_000_000)).cast("bigint").alias("minutes")))


def gaps(bars: DataFrame, lagged: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Consecutive bars more than 5 minutes apart whose hourly probes
    reach an open-market hour (parity: gaps of 60 minutes or less have no
    probe and are never reported, Q1; ``strict`` reports them). Copies of a
    timestamp are 0-minute steps, so the collapsed rows give the same gaps."""
    lagged = lagged_rows(bars) if lagged is None else lagged
    within = lagged.select("pair", "prev_ts", "timestamp")
    # the lagged rows are already clustered by (pair, date): no extra shuffle
    days = lagged.groupBy("pair", "_d").agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    wd = Window.partitionBy("pair").orderBy("_d")  # one row per pair-day
    across = days.select("pair", F.lag("last_ts").over(wd).alias("prev_ts"), F.col("first_ts").alias("timestamp"))
    steps = within.unionByName(across).select("pair", _gap(F.col("prev_ts"), F.col("timestamp"), strict).alias("g"))
    return steps.where(F.col("g").isNotNull()).select("pair", "g.*")


def _spike_flag(o: Column, pc: Column) -> Column:
    """pandas rules: NaN compares False; a zero previous close is a spike
    (inf) unless open is also zero (NaN). Division only behind the guard."""
    return F.coalesce(
        F.when(F.isnan(o) | F.isnan(pc), F.lit(False))
        .when(pc == 0, o != 0)
        .otherwise(F.abs((o - pc) / F.when(pc != 0, pc)) > F.lit(SPIKE_RATIO)),
        F.lit(False),
    )


def _spike_pct(o: Column, pc: Column) -> Column:
    return F.when(pc == 0, F.lit(float("inf"))).otherwise(
        F.round(F.abs((o - pc) / F.when(pc != 0, pc)) * 100, 3)
    )


def _spike_parts(lagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first copies vs the previous distinct row, repeated copies).

    The k-th copy (k >= 2) of a row follows an identical copy, so its previous
    close is its own close: it is a spike exactly when open vs own close is,
    and it repeats ``_n - 1`` times. Counting needs no expansion."""
    o, pc, c = F.col("open"), F.col("prev_close"), F.col("close")
    inter = lagged.where(pc.isNotNull() & _spike_flag(o, pc)).select(
        "pair", "timestamp", pc.alias("prev_close"), o.alias("open"), _spike_pct(o, pc).alias("pct_change"),
        "_k", F.lit(0).cast("bigint").alias("_copy"),
    )
    repeated = lagged.where((F.col("_n") > 1) & _spike_flag(o, c)).select(
        "pair", "timestamp", c.alias("prev_close"), o.alias("open"), _spike_pct(o, c).alias("pct_change"),
        "_k", (F.col("_n") - 1).alias("_reps"),
    )
    return inter, repeated


_EXPAND_CHUNK = 65536


def _expand(repeated: DataFrame) -> DataFrame:
    """One row per repeated copy (``_copy`` = 1.._reps). Large repeat counts
    are cut into chunks that are spread over tasks before the rows are
    generated."""
    chunks = repeated.withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_reps") - 1) / _EXPAND_CHUNK).cast("bigint")))
    ).repartition("pair", "timestamp", "_c")
    first = F.col("_c") * _EXPAND_CHUNK + 1
    last = F.least((F.col("_c") + 1) * _EXPAND_CHUNK, F.col("_reps"))
    return chunks.withColumn("_copy", F.explode(F.sequence(first, last))).drop("_reps", "_c")


def spikes(bars: DataFrame, lagged: DataFrame | None = None) -> DataFrame:
    """|open - previous close| / previous close > 5 % against the previous
    row of the same UTC date (previous row in time order, copies included)."""
    lagged = lagged_rows(bars) if lagged is None else lagged
    inter, repeated = _spike_parts(lagged)
    return inter.unionByName(_expand(repeated)).drop("_k", "_copy")


def _spike_examples_of_row() -> Column:
    """A row's own spikes in order, at most EXAMPLES of its repeated copies."""
    o, pc, c = F.col("open"), F.col("prev_close"), F.col("close")

    def one(prev: Column, copy: Column) -> Column:
        return F.struct(F.col("timestamp").alias("t"), F.col("_k").alias("k"), copy.cast("bigint").alias("copy"),
                        prev.alias("prev_close"), o.alias("open"), _spike_pct(o, prev).alias("pct_change"))

    first = F.when(pc.isNotNull() & _spike_flag(o, pc), F.array(one(pc, F.lit(0))))
    copies = F.when((F.col("_n") > 1) & _spike_flag(o, c), F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.least(F.col("_n") - 1, F.lit(EXAMPLES).cast("bigint"))), lambda k: one(c, k)))
    return F.flatten(F.array_compact(F.array(first, copies)))


def day_summary(lagged: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """Everything the report needs of a pair-day, one row each. The lagged rows
    lie together by (pair, date) already, so this costs no shuffle; a day's
    lists hold at most its own rows."""
    o, pc, c = F.col("open"), F.col("prev_close"), F.col("close")
    spike_n = (F.when(pc.isNotNull() & _spike_flag(o, pc), 1).otherwise(0)
               + F.when((F.col("_n") > 1) & _spike_flag(o, c), F.col("_n") - 1).otherwise(0))
    rows = lagged.select(
        "*", spike_n.alias("_spikes"), _spike_examples_of_row().alias("_sx"),
        _gap(F.col("prev_ts"), F.col("timestamp"), strict_gaps).alias("_gap"),
        F.when(F.col("prev_ts").isNull() | (F.col("prev_ts") != F.col("timestamp")), 1).otherwise(0).alias("_new"),
    )
    return rows.groupBy("pair", "_d").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
        F.sum("_n").alias("rows"), F.sum(F.col("_n") - F.col("_new")).alias("duplicates"),
        F.sum("_bad").alias("bad"), F.sum("_zero").alias("zero"), F.sum("_nohash").alias("nohash"),
        F.collect_set("source").alias("sources"),
        F.sum("_spikes").alias("spikes"), F.count("_gap").alias("gaps"),
        F.slice(F.array_sort(F.collect_list("_gap")), 1, EXAMPLES).alias("gx"),
        F.slice(F.array_sort(F.flatten(F.collect_list("_sx"))), 1, EXAMPLES).alias("sx"),
    )


def pair_summary(days: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """D5-D12, E1, E2 and F2 per pair from its days (one shuffle of pair-days):
    counts, ISO range, completeness, sources, rows per year, first examples."""
    w = Window.partitionBy("pair").orderBy("_d")
    across = _gap(F.lag("last_ts").over(w), F.col("first_ts"), strict_gaps)
    days = days.withColumn("_across", across)
    ex = F.when(F.col("_across").isNotNull(), F.concat(F.array("_across"), "gx")).otherwise(F.col("gx"))
    years = days.withColumn("gx", ex).groupBy("pair", F.year("_d").alias("year")).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("rows", "duplicates", "bad", "zero", "nohash", "spikes")],
        (F.sum("gaps") + F.count("_across")).cast("bigint").alias("gaps"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.array_distinct(F.flatten(F.collect_list("sources"))).alias("sources"),
        F.slice(F.array_sort(F.flatten(F.collect_list("gx"))), 1, EXAMPLES).alias("gx"),
        F.slice(F.array_sort(F.flatten(F.collect_list("sx"))), 1, EXAMPLES).alias("sx"),
    )
    out = years.groupBy("pair").agg(
        *[F.sum(c).cast("bigint").alias(n) for c, n in (
            ("rows", "total_bars"), ("duplicates", "duplicates"), ("bad", "ohlc_failures"), ("zero", "zero_volume"),
            ("nohash", "hash_nulls"), ("spikes", "spike_count"), ("gaps", "gap_count"))],
        F.min("first_ts").alias("start_ts"), F.max("last_ts").alias("end_ts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"),
        F.array_sort(F.collect_list(F.struct("year", F.col("rows").alias("n")))).alias("years"),
        F.slice(F.array_sort(F.flatten(F.collect_list("gx"))), 1, EXAMPLES).alias("gx"),
        F.slice(F.array_sort(F.flatten(F.collect_list("sx"))), 1, EXAMPLES).alias("sx"),
    )
    expected = open_minutes_between("start_ts", "end_ts")
    return out.select(
        "*", iso_utc("start_ts").alias("start"), iso_utc("end_ts").alias("end"), expected.alias("expected"),
        F.when(expected > 0, F.round(F.col("total_bars") / expected * 100, 2)).otherwise(F.lit(0.0)).alias("percent"),
    )


def pair_checks(bars: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """The pair table of ``bars`` in one pass."""
    return pair_summary(day_summary(lagged_rows(bars), strict_gaps), strict_gaps)


def yearly_counts(pairs: DataFrame) -> DataFrame:
    """Rows per (pair, year)."""
    return pairs.select("pair", F.explode("years").alias("y")).select("pair", "y.year", "y.n")


def gap_examples(pairs: DataFrame) -> DataFrame:
    """the first gaps per pair, with their rank."""
    g = pairs.select("pair", F.posexplode("gx").alias("pos", "g"))
    return g.select("pair", (F.col("pos") + 1).alias("rank"), "g.from_ts", "g.to_ts", "g.minutes")


def spike_examples(pairs: DataFrame) -> DataFrame:
    """the first spikes per pair in row order, with their rank."""
    x = pairs.select("pair", F.posexplode("sx").alias("pos", "s"))
    return x.select("pair", F.col("s.t").alias("timestamp"), "s.prev_close", "s.open", "s.pct_change", (F.col("pos") + 1).alias("rank"))


def qa_report(bars: DataFrame, inst: DataFrame, strict_gaps: bool = False) -> DataFrame:
    """One row per configured pair with every check nested; pairs with
    no bars get ``status = 'no_data'`` (C4)."""
    return report_of(pair_checks(bars, strict_gaps), inst)


def report_of(pairs: DataFrame, inst: DataFrame) -> DataFrame:
    """D14 from the pair table (``pair_summary``)."""
    per_pair = inst.select("pair", "pair_ord").join(pairs, "pair", "left")
    gap_list = F.transform("gx", lambda g: F.struct(
        iso_utc(g["from_ts"]).alias("from"), iso_utc(g["to_ts"]).alias("to"), g["minutes"].alias("minutes")))
    spike_list = F.transform("sx", lambda x: F.struct(
        iso_utc(x["t"]).alias("timestamp"), x["prev_close"].alias("prev_close"), x["open"].alias("open"), x["pct_change"].alias("pct_change")))
    passed = lambda c: F.struct(F.col(c).alias("count"), (F.col(c) == 0).alias("pass"))
    checks = F.struct(
        passed("duplicates").alias("duplicates"),
        F.struct(F.col("ohlc_failures").alias("failures"), (F.col("ohlc_failures") == 0).alias("pass")).alias("ohlc_integrity"),
        F.struct(F.col("zero_volume").alias("count")).alias("zero_volume"),
        F.struct(F.col("gap_count").alias("count"), gap_list.alias("examples")).alias("gaps_over_5min"),
        F.struct("percent", F.col("total_bars").alias("actual"), "expected").alias("completeness"),
        F.struct(F.col("sources").alias("values")).alias("sources"),
        passed("hash_nulls").alias("bar_hash_nulls"),
        F.struct(F.col("spike_count").alias("count"), spike_list.alias("examples")).alias("price_spikes_5pct"),
        F.map_from_entries(F.transform("years", lambda y: F.struct(y["year"].cast("string"), y["n"]))).alias("yearly_row_counts"),
    )
    there = F.col("total_bars").isNotNull()
    return per_pair.select(
        "pair", "pair_ord", F.when(there, F.lit("ok")).otherwise(F.lit("no_data")).alias("status"), "total_bars",
        F.when(there, F.struct("start", "end")).alias("date_range"), F.when(there, checks).alias("checks"),
    )


def qa_report_json(report: DataFrame) -> DataFrame:
    """The report as JSON text, one document per pair."""
    body = F.when(
        F.col("status") == "no_data", F.to_json(F.struct(F.col("status")))
    ).otherwise(F.to_json(F.struct("total_bars", "date_range", "checks")))
    return report.select("pair", body.alias("json"))


def qa_report_document(report: DataFrame, generated_at: Column) -> DataFrame:
    """The whole report as one JSON document, shaped like the reference's
    file: ``{"generated_at": ..., "pairs": {PAIR: {...}}}`` with
    ``{"status": "no_data"}`` for pairs without bars (``to_json`` drops NULL
    fields). Pairs keep the configured order. One row per pair is folded, so
    the collected list is bounded by the instrument count."""
    value = F.struct(
        F.when(F.col("status") == "no_data", F.lit("no_data")).alias("status"),
        "total_bars", "date_range", "checks",
    )
    entries = F.array_sort(
        F.collect_list(F.struct("pair_ord", "pair", value.alias("v"))),
        lambda a, b: F.when(a["pair_ord"] < b["pair_ord"], -1).when(a["pair_ord"] > b["pair_ord"], 1).otherwise(0),
    )
    pairs = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["pair"], e["v"])))
    return report.agg(
        F.to_json(F.struct(generated_at.alias("generated_at"), pairs.alias("pairs"))).alias("json")
    )


def read_report_document(documents: DataFrame, schema) -> DataFrame:
    """A9 read back: one row per pair of the saved documents (one text row
    each), typed as the report's ``schema``, with ``generated_at`` as text."""
    names = ["status", "total_bars", "date_range", "checks"]
    value = T.StructType([schema[c] for c in names])
    whole = T.StructType([T.StructField("generated_at", T.StringType()), T.StructField("pairs", T.MapType(T.StringType(), value))])
    doc = documents.select(F.from_json("value", whole).alias("d"))
    rows = doc.select("d.generated_at", F.explode("d.pairs").alias("pair", "v"))
    return rows.select("pair", F.coalesce("v.status", F.lit("ok")).alias("status"), *[F.col(f"v.{c}").alias(c) for c in names[1:]], "generated_at")


def flatten_report(report: DataFrame) -> DataFrame:
    """The report's checks as scalar columns (one row per pair): handy for
    tabular consumers and for comparing with other engines. A pair without
    bars gets zero counts (the reference's convention for an empty frame:
    total 0, completeness 0.0 of 0) and NULL pass flags, dates and examples; pass
    flags are text ('true'/'false'), examples comma-joined text with values in
    millionths."""
    c = F.col("checks")
    years = F.array_join(F.array_sort(F.transform(
        F.map_entries(c["yearly_row_counts"]), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))
    )), ",")
    gap_text = F.array_join(F.transform(c["gaps_over_5min"]["examples"], lambda g: F.concat_ws("/", g["from"], g["to"], g["minutes"].cast("string"))), ",")
    micro = lambda v: F.round(v * 1_000_000).cast("bigint").cast("string")
    spike_text = F.array_join(F.transform(c["price_spikes_5pct"]["examples"], lambda x: F.concat_ws(
        "/", x["timestamp"], micro(x["prev_close"]), micro(x["open"]), micro(x["pct_change"]))), ",")
    z = lambda col, t="bigint": F.coalesce(col, F.lit(0).cast(t))
    return report.select(
        "pair", "status", z(F.col("total_bars")).alias("total_bars"),
        F.col("date_range.start").alias("start"), F.col("date_range.end").alias("end"),
        z(c["duplicates"]["count"]).alias("duplicates"), c["duplicates"]["pass"].cast("string").alias("duplicates_pass"),
        z(c["ohlc_integrity"]["failures"]).alias("ohlc_failures"), c["ohlc_integrity"]["pass"].cast("string").alias("ohlc_pass"),
        z(c["zero_volume"]["count"]).alias("zero_volume"),
        z(c["gaps_over_5min"]["count"]).alias("gap_count"),
        gap_text.alias("gap_examples"),
        z(c["completeness"]["percent"], "double").alias("completeness_percent"),
        z(c["completeness"]["actual"]).alias("completeness_actual"),
        z(c["completeness"]["expected"]).alias("completeness_expected"),
        F.array_join(c["sources"]["values"], ",").alias("sources"),
        z(c["bar_hash_nulls"]["count"]).alias("hash_nulls"), c["bar_hash_nulls"]["pass"].cast("string").alias("hash_pass"),
        z(c["price_spikes_5pct"]["count"]).alias("spike_count"),
        spike_text.alias("spike_examples"),
        years.alias("yearly_row_counts"),
    )
