"""QA report vs the checks' definitions on random bars
(weekends, midnight crossings, duplicates, zero closes)."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from test_calendar import has_open_probe, open_count

from tickweave.operators import quality as Q
from tickweave.schemas import BAR_SCHEMA
from tickweave.sources.instruments import instruments


def expected_checks(rows):
    """What the definitions say of one pair's rows (time, open, close, in row
    order): gaps from the sets of probes and closed minutes, spikes from the
    ratio table of neighbours on one date."""
    times = sorted({t for t, _, _ in rows})
    steps = [(a, b) for a, b in zip(times, times[1:]) if b - a > dt.timedelta(minutes=5) and has_open_probe(a, b)]
    table = pd.DataFrame(rows, columns=["t", "open", "close"])
    table["before"] = table.groupby(table["t"].dt.date)["close"].shift()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.abs((table["open"].to_numpy() - table["before"].to_numpy()) / table["before"].to_numpy())
    hit = table[ratio > 0.05]
    return {
        "gaps": [(a, b, int((b - a).total_seconds() / 60)) for a, b in steps],
        "spikes": [(t.to_pydatetime(), p, o) for t, p, o in zip(hit["t"], hit["before"], hit["open"])],
        "expected": open_count(times[0], times[-1]),
    }


def test_report_matches_brute_force(spark):
    rnd = random.Random(3)
    data = []
    for pair in ("EURUSD", "USDJPY"):
        t = dt.datetime(2024, 1, 4, 20, 0)
        for _ in range(400):
            t += dt.timedelta(minutes=rnd.choice([1, 1, 2, 3, 6, 30, 59, 60, 61, 62, 90, 180, 700, 2900]))
            o = rnd.choice([1.0, 1.02, 1.1, 0.0, 1.5])
            c = rnd.choice([1.0, 1.03, 0.0, 1.2])
            row = (pair, None, t, o, max(o, c), min(o, c), c, 1.0, "dukascopy")
            data.append(row)
            if rnd.random() < 0.08:  # a re-delivered copy with a different close
                c2 = c + 0.5
                data.append((pair, None, t, o, max(o, c2), min(o, c2), c2, 1.0, "dukascopy"))
    bars = spark.createDataFrame(data, BAR_SCHEMA)
    rep = {r["pair"]: r for r in Q.qa_report(bars, instruments(spark)).collect()}
    for pair in ("EURUSD", "USDJPY"):
        rows = sorted(((r[2], r[3], r[6]) for r in data if r[0] == pair), key=lambda x: (x[0], x[1], x[2]))
        want = expected_checks(rows)
        c = rep[pair]["checks"]
        assert c["gaps_over_5min"]["count"] == len(want["gaps"])
        got_gaps = [(g["from"], g["to"], g["minutes"]) for g in c["gaps_over_5min"]["examples"]]
        iso = lambda t: t.strftime("%Y-%m-%dT%H:%M:%S+00:00")
        assert got_gaps == [(iso(a), iso(b), m) for a, b, m in want["gaps"][:10]]
        assert c["price_spikes_5pct"]["count"] == len(want["spikes"])
        got_sp = [(s["timestamp"], s["prev_close"], s["open"]) for s in c["price_spikes_5pct"]["examples"]]
        assert got_sp == [(iso(t), pc, o) for t, pc, o in want["spikes"][:10]]
        assert c["completeness"]["expected"] == want["expected"]
        assert c["duplicates"]["count"] == len(rows) - len({r[0] for r in rows})
