"""Write PLANS.md: the physical plan trees of the headline operators.

Usage: python tools/plan_report.py [sf_dir]
The trees come from ``explain("formatted")`` (header part only) of plans
built over the given scale; shuffle counts are the ``Exchange`` nodes.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    """The plan tree plus, for each scan, its pushed/partition filters and
    read schema."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head, _, details = text.partition("\n\n\n")
    scans, exchanges = [], set()
    for block in details.split("\n\n"):
        blines = block.strip().splitlines()
        if blines and "Exchange" in blines[0] and "Broadcast" not in blines[0]:
            args = [ln for ln in blines if ln.startswith("Arguments")]
            inp = [ln for ln in blines if ln.startswith("Input")]
            exchanges.add((tuple(args), tuple(inp)))
        lines = block.strip().splitlines()
        if lines and "Scan" in lines[0]:
            keep = [ln for ln in lines[1:] if ln.split(":")[0] in ("PartitionFilters", "PushedFilters", "ReadSchema")]
            if keep:
                scans.append("\n".join([lines[0]] + ["    " + k for k in keep]))
    out = head.replace("== Physical Plan ==\n", "")
    if scans:
        out += "\n\n" + "\n".join(scans)
    return out, len(exchanges)


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from tickweave.operators.bars import minute_bars
    from tickweave.operators.quality import qa_report
    from tickweave.plans.load import aggregated
    from tickweave.plans.registry import land_fixture_files, qa_store
    from tickweave.session import local_session
    from tickweave.sources import fixtures as FX
    from tickweave.sources.barstore import read_store
    from tickweave.sources.instruments import instruments
    from tickweave.sources.tickformat import tick_format
    from tickweave.operators.hourmaps import next_batch, slot_maps
    from tickweave.operators.slots import pair_quota

    spark = local_session()
    raw = land_fixture_files(spark, sf_dir)
    store = qa_store(spark, sf_dir)
    start, as_of = FX.fixture_range(spark, sf_dir)
    cat = FX.fixture_catalog(spark, sf_dir)
    plans = {
        "load (decode + 1-minute bars, A1 + D1)": aggregated(
            tick_format(spark).load(raw).where("pair = 'EURUSD'"), instruments(spark)),
        "minute_bars over the events fixture (D1)": minute_bars(FX.fixture_ordered_ticks(spark, sf_dir)),
        "QA report over the stored bars (D14)": qa_report(read_store(spark, store), instruments(spark)),
        "next_batch (C1 + E4)": next_batch(spark, slot_maps(cat), as_of, pair_quota(instruments(spark), 100), 100, start),
        "stored-bar scan with a pair filter (A4 + B11)": read_store(spark, store, ["EURUSD"]).select(
            "timestamp", "close"),
    }
    out = ["# PLANS", "",
           f"Physical plans (before adaptive re-planning) at `{sf_dir}`, from "
           "`tools/plan_report.py`. `Exchange` = shuffle; `BroadcastExchange` only "
           "carries the fixed instrument table or tiny per-pair tables.", ""]
    for title, df in plans.items():
        t, distinct = tree(df)
        n_ex = sum(1 for line in t.splitlines() if "Exchange" in line and "Broadcast" not in line)
        out += [f"## {title}", "",
                f"exchange nodes in the tree: {n_ex} (a subtree used by several branches is listed once per use; "
                "adaptive execution reuses its shuffle)",
                "", "```", t.rstrip(), "```", ""]
    merge_note = [
        "## merge_bars (G3)", "",
        "Minute maps of the batch and of the store are united by (pair, year, bucket) and their "
        "bits counted to find colliding "
        "partitions. Colliding ones: union stored + new, partial `min_by` keep-first "
        "aggregate before one exchange, final aggregate, integrity filter, "
        "`rebalance(pair, year)` exchange, sorted dynamic-overwrite write. The others: the "
        "batch's own keep-first and integrity filter, appended. See README.", "",
    ]
    out += merge_note
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
