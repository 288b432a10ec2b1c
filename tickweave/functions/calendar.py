"""Trading-calendar column expressions (UTC).

The market is closed all Saturday, Sunday before 22:00 and Friday from 22:00.
Expressed on the hour-of-week ``wh = weekday*24 + hour`` (Monday = 0), the
closure is the half-open range [118, 166).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the closure: Friday 22:00 .. Sunday 22:00, as hour-of-week.
CLOSE_HOW = 4 * 24 + 22   # 118
OPEN_HOW = 6 * 24 + 22    # 166
WEEK_HOURS = 168
WEEK_MINUTES = WEEK_HOURS * 60          # 10080
OPEN_MINUTES_PER_WEEK = (CLOSE_HOW + WEEK_HOURS - OPEN_HOW) * 60  # 120 h = 7200
# A Sunday 22:00 UTC (market opening) used as the origin of open-minute counting.
WEEK_ORIGIN = "2020-12-27 22:00:00"
WEEK_ORIGIN_EPOCH = 1609106400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(a: Column, b: int) -> Column:
    """Exact integer floor division for a positive constant divisor."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def hour_of_week(ts) -> Column:
    ts = _col(ts)
    return F.weekday(ts) * 24 + F.hour(ts)


def market_closed(ts) -> Column:
    """True when ``ts`` (UTC) falls in the weekend closure."""
    wh = hour_of_week(ts)
    return (wh >= CLOSE_HOW) & (wh < OPEN_HOW)


def open_minutes_before(ts) -> Column:
    """Open-market minutes in [origin, floor_minute(ts)), closed form.

    Weeks are counted from a Sunday 22:00 opening; each week holds 7200 open
    minutes followed by 2880 closed ones.
    """
    m = floor_div(
        F.unix_seconds(_col(ts)) - F.lit(WEEK_ORIGIN_EPOCH), 60
    )
    return floor_div(m, WEEK_MINUTES) * OPEN_MINUTES_PER_WEEK + F.least(
        F.pmod(m, F.lit(WEEK_MINUTES)), F.lit(OPEN_MINUTES_PER_WEEK)
    )


def open_minutes_between(start, end) -> Column:
    """Open minutes among floor_minute(start), +1 min, ... <= end (inclusive)."""
    end_next = _col(end) + F.expr("INTERVAL 1 MINUTE")
    return (open_minutes_before(end_next) - open_minutes_before(start)).cast("bigint")


def gap_has_open_probe(start, end) -> Column:
    """Is any hourly probe start+1h, start+2h, ... (< end) in open market?

    Probes are one hour apart, so their hour-of-week values are consecutive.
    With K probes, K >= 49 always reaches an open hour (the closure is 48 h);
    otherwise the probes are all closed iff they sit inside [118, 166).
    K = 0 (a gap of at most one hour) has no probe: never reported.
    """
    start, end = _col(start), _col(end)
    diff_us = F.unix_micros(end) - F.unix_micros(start)
    k = F.when(diff_us > 0, floor_div(diff_us - 1, 3_600_000_000)).otherwise(F.lit(0))
    first = hour_of_week(start) + 1
    offset = F.pmod(first - CLOSE_HOW, F.lit(WEEK_HOURS))
    return (k >= 1) & ((k > (OPEN_HOW - CLOSE_HOW)) | (offset + k > (OPEN_HOW - CLOSE_HOW)))
