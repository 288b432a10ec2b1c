"""DuckDB oracle SQL for the registered queries.

Each statement recomputes the query from the raw ``events`` view with the
same fixture mapping, written independently in plain SQL (brute-force forms
where the Spark side uses a closed form), so agreement is a real check.
"""

from __future__ import annotations

from ..sources.fixtures import EVENT_TYPE_PAIR, KNOWLEDGE_TIME_1, KNOWLEDGE_TIME_2, OTHER_PAIR
from ..sources.instruments import BASE_URL, DEFAULT_SOURCE, instruments_sql_values

_PAIR_CASE = "CASE event_type " + " ".join(
    f"WHEN '{et}' THEN '{p}'" for et, p in EVENT_TYPE_PAIR
) + f" ELSE '{OTHER_PAIR}' END"

CLOSED_SQL = (
    "(CASE WHEN (isodow({t}) - 1) * 24 + hour({t}) >= 118 "
    "AND (isodow({t}) - 1) * 24 + hour({t}) < 166 THEN TRUE ELSE FALSE END)"
)


def closed(t: str) -> str:
    return CLOSED_SQL.format(t=t)


BASE = f"""
WITH instruments AS (SELECT * FROM {instruments_sql_values()}),
ev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, {_PAIR_CASE} AS pair,
         date_trunc('hour', CAST(ts AS TIMESTAMP)) AS slot,
         CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT) AS k,
         100000 + CAST(round(value * 100) AS BIGINT) AS bid_int
  FROM events
),
raw_ticks AS (
  SELECT pair, slot, event_id,
         CAST(row_number() OVER (PARTITION BY pair, slot ORDER BY ts, event_id) - 1 AS INTEGER) AS seq,
         CAST((epoch_us(ts) - epoch_us(slot)) // 1000 AS BIGINT) AS ms,
         CAST(bid_int + 1 + k % 5 AS BIGINT) AS ask_int,
         CAST(bid_int AS BIGINT) AS bid_int,
         CAST(k AS DOUBLE) AS ask_volume,
         CAST(event_id % 7 AS DOUBLE) AS bid_volume
  FROM ev
),
ticks AS (
  SELECT r.pair, r.slot, r.seq, r.event_id,
         make_timestamp(epoch_us(r.slot) + r.ms * 1000) AS timestamp,
         CAST(r.ask_int AS DOUBLE) / i.point_value AS ask,
         CAST(r.bid_int AS DOUBLE) / i.point_value AS bid,
         (CAST(r.ask_int AS DOUBLE) / i.point_value + CAST(r.bid_int AS DOUBLE) / i.point_value) / 2.0 AS mid,
         r.ask_volume, r.bid_volume
  FROM raw_ticks r LEFT JOIN instruments i ON r.pair = i.pair
),
bars AS (
  SELECT pair, slot, date_trunc('minute', timestamp) AS timestamp,
         arg_min(mid, seq) AS open, max(mid) AS high, min(mid) AS low,
         arg_max(mid, seq) AS close, sum(ask_volume + bid_volume) AS volume,
         '{DEFAULT_SOURCE}' AS source
  FROM ticks GROUP BY 1, 2, 3
)
"""


def q(body: str) -> str:
    return BASE + body


ORACLE: dict[str, str] = {}

ORACLE["minute_bars"] = q("SELECT * FROM bars")

ORACLE["tick_prices"] = q(
    "SELECT pair, slot, event_id, ask, bid, mid FROM ticks"
)

ORACLE["tick_time"] = q("SELECT pair, slot, event_id, timestamp FROM ticks")

ORACLE["tick_volume"] = q(
    "SELECT pair, slot, event_id, ask_volume + bid_volume AS total_volume FROM ticks"
)

ORACLE["market_closed"] = q(
    f"SELECT event_id, ts, {closed('ts')} AS closed FROM ev"
)


def hash_sql() -> str:
    parts = ["strftime(timestamp, '%Y-%m-%dT%H:%M:%S+00:00')"] + [
        f"CAST({c} AS VARCHAR)" for c in ("open", "high", "low", "close", "volume")
    ] + ["source"]
    return "sha256(" + " || '|' || ".join(parts) + ")"


BAD_SQL = "(high < greatest(open, close) OR low > least(open, close) OR high < low OR volume < 0)"
OHLC_BAD_SQL = "(high < greatest(open, close) OR low > least(open, close) OR high < low)"

BATCH_CTES = f""",
batch1 AS (
  SELECT pair, slot, timestamp, open,
         CASE WHEN minute(timestamp) % 13 = 0 THEN low ELSE high END AS high,
         CASE WHEN minute(timestamp) % 13 = 0 THEN high ELSE low END AS low,
         close,
         CASE WHEN minute(timestamp) % 31 = 0 THEN -1.0 ELSE volume END AS volume,
         source
  FROM bars
),
batch2 AS (
  SELECT pair, slot, timestamp, open, high, low, close + 0.01 AS close, volume, source
  FROM bars WHERE minute(timestamp) % 10 = 0
),
stamped AS (
  SELECT *, TIMESTAMP '{KNOWLEDGE_TIME_1}' AS knowledge_time, {hash_sql()} AS bar_hash FROM bars
),
stamped1 AS (
  SELECT *, TIMESTAMP '{KNOWLEDGE_TIME_1}' AS knowledge_time, {hash_sql()} AS bar_hash FROM batch1
),
stamped2 AS (
  SELECT *, TIMESTAMP '{KNOWLEDGE_TIME_2}' AS knowledge_time, {hash_sql()} AS bar_hash FROM batch2
),
union_sn AS (
  SELECT pair, CAST(NULL AS TIMESTAMP) AS slot, timestamp, open, high, low, close, volume, source,
         knowledge_time, bar_hash, 0 AS is_new FROM stamped
  UNION ALL
  SELECT pair, slot, timestamp, open, high, low, close, volume, source,
         knowledge_time, bar_hash, 1 AS is_new FROM stamped2
),
store1 AS (SELECT * FROM stamped1 WHERE NOT {BAD_SQL}),
union12 AS (
  SELECT pair, CAST(NULL AS TIMESTAMP) AS slot, timestamp, open, high, low, close, volume, source,
         knowledge_time, bar_hash, 0 AS is_new FROM store1
  UNION ALL
  SELECT pair, slot, timestamp, open, high, low, close, volume, source,
         knowledge_time, bar_hash, 1 AS is_new FROM stamped2
),
store2 AS (
  SELECT * FROM union12
  QUALIFY row_number() OVER (PARTITION BY pair, timestamp
            ORDER BY is_new, slot DESC NULLS LAST, bar_hash, open, high, low, close, volume) = 1
)
"""

STORE_COLS = (
    "timestamp, open, high, low, close, volume, source, knowledge_time, bar_hash, pair, "
    "CAST(year(timestamp) AS INTEGER) AS year"
)


def qb(body: str) -> str:
    return BASE + BATCH_CTES + body


ORACLE["bars_valid"] = qb(f"SELECT * FROM batch1 WHERE NOT {BAD_SQL}")
ORACLE["bars_rejected"] = qb(f"SELECT * FROM batch1 WHERE {BAD_SQL}")
ORACLE["stamp_bars"] = qb("SELECT * FROM stamped")
ORACLE["bar_hash"] = qb(f"SELECT pair, timestamp, {hash_sql()} AS bar_hash FROM bars")
ORACLE["bars_union"] = qb("SELECT * FROM union_sn")
ORACLE["bars_dedup"] = qb(
    "SELECT * FROM union_sn QUALIFY row_number() OVER (PARTITION BY pair, timestamp "
    "ORDER BY is_new, slot DESC NULLS LAST, bar_hash, open, high, low, close, volume) = 1"
)
ORACLE["bar_sink_roundtrip"] = qb(f"SELECT {STORE_COLS} FROM stamped WHERE NOT {BAD_SQL}")
ORACLE["pair_filter"] = qb(
    f"SELECT {STORE_COLS} FROM stamped WHERE NOT {BAD_SQL} AND pair IN ('EURUSD', 'USDJPY')"
)
ORACLE["bar_scan"] = qb(f"SELECT {STORE_COLS} FROM store1")
ORACLE["merge_bars"] = qb(f"SELECT {STORE_COLS} FROM store2 WHERE NOT {BAD_SQL}")
# the same rows by way of files of the other layout
ORACLE["bar_files_scan"] = ORACLE["bar_scan"]
ORACLE["bar_files_merge"] = ORACLE["merge_bars"]


SLOT_PARTS_SQL = (
    "CAST(year(slot) AS SMALLINT) AS year, CAST(month(slot) AS TINYINT) AS month, "
    "CAST(day(slot) AS TINYINT) AS day, CAST(hour(slot) AS TINYINT) AS hour"
)

SLOT_CTES = f""",
rng AS (
  SELECT date_trunc('day', min(ts)) AS start,
         date_trunc('day', max(ts)) + INTERVAL 1 DAY AS as_of FROM ev
),
hours AS (
  SELECT unnest(generate_series(start, as_of - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slot FROM rng
),
expected AS (
  SELECT i.pair, i.pair_ord, h.slot,
         CAST(year(h.slot) AS SMALLINT) AS year, CAST(month(h.slot) AS TINYINT) AS month,
         CAST(day(h.slot) AS TINYINT) AS day, CAST(hour(h.slot) AS TINYINT) AS hour,
         (epoch_us(h.slot) - (SELECT epoch_us(start) FROM rng)) // 3600000000 AS idx
  FROM hours h CROSS JOIN instruments i
  WHERE NOT {closed('h.slot')}
),
tick_slots AS (SELECT DISTINCT pair, slot FROM raw_ticks),
catalog0 AS (
  SELECT e.pair, e.year, e.month, e.day, e.hour,
         CASE WHEN t.pair IS NOT NULL THEN 'fetched'
              WHEN e.idx % 17 = 0 THEN 'no_data'
              WHEN e.idx % 29 = 0 THEN 'error' END AS status,
         (SELECT as_of FROM rng) AS fetched_at
  FROM expected e LEFT JOIN tick_slots t ON e.pair = t.pair AND e.slot = t.slot
),
catalog AS (SELECT * FROM catalog0 WHERE status IS NOT NULL),
updates AS (
  SELECT pair, year, month, day, hour, 'error' AS status,
         (SELECT as_of FROM rng) + INTERVAL 1 HOUR AS fetched_at, 1 AS update_seq
  FROM expected WHERE idx % 5 = 0
  UNION ALL
  SELECT pair, year, month, day, hour, 'fetched' AS status,
         (SELECT as_of FROM rng) + INTERVAL 2 HOUR AS fetched_at, 2 AS update_seq
  FROM expected WHERE idx % 10 = 0
),
upserted AS (
  SELECT pair, year, month, day, hour, status, fetched_at FROM (
    SELECT *, 0 AS src, 0 AS seq FROM catalog
    UNION ALL
    SELECT pair, year, month, day, hour, status, fetched_at, 1 AS src, update_seq AS seq FROM updates
  ) QUALIFY row_number() OVER (PARTITION BY pair, year, month, day, hour ORDER BY src DESC, seq DESC) = 1
),
pending AS (
  SELECT e.* FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.pair = e.pair AND c.year = e.year
                    AND c.month = e.month AND c.day = e.day AND c.hour = e.hour)
),
quota AS (
  SELECT pair, pair_ord,
         CAST({{max_hours}} // n + CASE WHEN rn <= {{max_hours}} % n THEN 1 ELSE 0 END AS INTEGER) AS quota
  FROM (SELECT i.pair, i.pair_ord, row_number() OVER (ORDER BY i.pair_ord) AS rn, count(*) OVER () AS n
        FROM instruments i WHERE i.pair IN (SELECT DISTINCT pair FROM catalog))
),
next_batch AS (
  SELECT p.pair, q.pair_ord, p.slot, p.year, p.month, p.day, p.hour, p.rank FROM (
    SELECT pair, slot, year, month, day, hour,
           CAST(row_number() OVER (PARTITION BY pair ORDER BY slot DESC) AS INTEGER) AS rank
    FROM pending) p JOIN quota q ON p.pair = q.pair
  WHERE p.rank <= q.quota
),
error_batch AS (
  SELECT p.pair, q.pair_ord, p.slot, p.year, p.month, p.day, p.hour, p.rank FROM (
    SELECT pair, make_timestamp(year, month, day, hour, 0, 0) AS slot, year, month, day, hour,
           CAST(row_number() OVER (PARTITION BY pair ORDER BY year DESC, month DESC, day DESC, hour DESC) AS INTEGER) AS rank
    FROM catalog WHERE status = 'error') p JOIN quota q ON p.pair = q.pair
  WHERE p.rank <= q.quota
)
"""

_QUOTA = 100


def qs(body: str) -> str:
    return BASE + SLOT_CTES.replace("{max_hours}", str(_QUOTA)) + body


ORACLE["expected_slots"] = qs("SELECT pair, pair_ord, slot, year, month, day, hour FROM expected")
ORACLE["catalog_scan"] = qs("SELECT * FROM catalog")
ORACLE["pending_slots"] = qs("SELECT pair, pair_ord, slot, year, month, day, hour FROM pending")
ORACLE["slot_status"] = qs(
    "SELECT e.pair, e.pair_ord, e.slot, e.year, e.month, e.day, e.hour, c.status FROM expected e "
    "LEFT JOIN catalog c ON c.pair = e.pair AND c.year = e.year AND c.month = e.month "
    "AND c.day = e.day AND c.hour = e.hour"
)
ORACLE["slot_exists"] = qs(
    "SELECT e.pair, e.pair_ord, e.slot, e.year, e.month, e.day, e.hour FROM expected e "
    "WHERE EXISTS (SELECT 1 FROM catalog c WHERE c.pair = e.pair AND c.year = e.year "
    "AND c.month = e.month AND c.day = e.day AND c.hour = e.hour)"
)
ORACLE["pair_quota"] = qs("SELECT * FROM quota")
ORACLE["next_batch"] = qs("SELECT * FROM next_batch")
ORACLE["error_batch"] = qs("SELECT * FROM error_batch")
ORACLE["worklist"] = qs(
    "SELECT *, row_number() OVER (ORDER BY rank, pair_ord) AS position FROM next_batch"
)
ORACLE["download_manifest"] = qs(
    "SELECT pair, year, month, day, hour, "
    f"printf('{BASE_URL}/%s/%d/%02d/%02d/%02dh_ticks.bi5', pair, year, month - 1, day, hour) AS url, "
    "printf('raw/%s/%d/%02d/%02d/%02dh_ticks.bi5', pair, year, month, day, hour) AS path "
    "FROM pending"
)
ORACLE["catalog_upsert"] = qs("SELECT * FROM upserted")
ORACLE["catalog_sink_roundtrip"] = qs("SELECT * FROM upserted")


ORACLE["pair_status"] = qs(
    "SELECT i.pair, i.pair_ord, CAST(coalesce(a.total, 0) AS BIGINT) AS total, "
    "CAST(coalesce(a.fetched, 0) AS BIGINT) AS fetched, CAST(coalesce(a.no_data, 0) AS BIGINT) AS no_data, "
    "CAST(coalesce(a.error, 0) AS BIGINT) AS error, a.oldest, a.newest FROM instruments i LEFT JOIN ("
    "  SELECT pair, count(*) AS total, count(*) FILTER (WHERE status = 'fetched') AS fetched,"
    "  count(*) FILTER (WHERE status = 'no_data') AS no_data, count(*) FILTER (WHERE status = 'error') AS error,"
    "  strftime(min(make_date(year, month, day)) FILTER (WHERE status = 'fetched'), '%Y-%m-%d') AS oldest,"
    "  strftime(max(make_date(year, month, day)) FILTER (WHERE status = 'fetched'), '%Y-%m-%d') AS newest"
    "  FROM catalog GROUP BY pair) a ON a.pair = i.pair"
)
ORACLE["status_rollup"] = qs(
    "SELECT pair, CAST(sum(total) AS BIGINT) AS total, CAST(sum(fetched) AS BIGINT) AS fetched, "
    "CAST(sum(no_data) AS BIGINT) AS no_data, CAST(sum(error) AS BIGINT) AS error, "
    "grouping(pair) = 1 AS is_total FROM ("
    "  SELECT i.pair, count(c.status) AS total, count(*) FILTER (WHERE c.status = 'fetched') AS fetched,"
    "  count(*) FILTER (WHERE c.status = 'no_data') AS no_data, count(*) FILTER (WHERE c.status = 'error') AS error"
    "  FROM instruments i LEFT JOIN catalog c ON c.pair = i.pair GROUP BY i.pair"
    ") GROUP BY ROLLUP (pair)"
)
ORACLE["slot_counts"] = q(
    "SELECT pair, slot, CAST(count(*) AS BIGINT) AS n_ticks, "
    "CAST(count(DISTINCT date_trunc('minute', timestamp)) AS BIGINT) AS n_bars FROM ticks GROUP BY pair, slot"
)
ORACLE["run_counts"] = qs(
    "SELECT a.pair, CAST(count(*) AS BIGINT) AS slots, CAST(sum(coalesce(b.n, 0)) AS BIGINT) AS bars FROM ("
    "  SELECT pair, slot FROM tick_slots UNION"
    "  SELECT pair, slot FROM expected WHERE idx % 17 = 0 OR idx % 29 = 0) a "
    "LEFT JOIN (SELECT pair, slot, count(*) AS n FROM bars GROUP BY 1, 2) b ON b.pair = a.pair AND b.slot = a.slot "
    "GROUP BY a.pair"
)

ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00')"

QA_CTES = f""",
qa AS (
  SELECT pair, slot, timestamp, open, high, low, close, volume, source, knowledge_time, bar_hash FROM stamped1
  UNION ALL
  SELECT pair, slot, timestamp, open, high, low, close, volume, source, knowledge_time, bar_hash FROM stamped2
),
qa_lag AS (
  SELECT pair, timestamp, open, close, knowledge_time, bar_hash,
         lag(timestamp) OVER w AS prev_ts, lag(close) OVER w AS prev_close
  FROM qa WINDOW w AS (PARTITION BY pair ORDER BY timestamp, knowledge_time, bar_hash, open, close)
),
qa_gap_rows AS (
  SELECT l.pair, l.prev_ts AS from_ts, l.timestamp AS to_ts,
         CAST((epoch_us(l.timestamp) - epoch_us(l.prev_ts)) // 60000000 AS BIGINT) AS minutes
  FROM qa_lag l
  WHERE l.prev_ts IS NOT NULL AND l.timestamp > l.prev_ts + INTERVAL 5 MINUTE
    AND EXISTS (
      SELECT 1 FROM (SELECT unnest(generate_series(l.prev_ts + INTERVAL 1 HOUR,
                                                   l.timestamp - INTERVAL 1 MICROSECOND,
                                                   INTERVAL 1 HOUR)) AS p) probes
      WHERE NOT {closed('probes.p')})
),
qa_spike_rows AS (
  SELECT pair, timestamp, prev_close, open, knowledge_time, bar_hash,
         CASE WHEN prev_close = 0 THEN CAST('inf' AS DOUBLE)
              ELSE round(abs((open - prev_close) / prev_close) * 100, 3) END AS pct_change
  FROM qa_lag
  WHERE prev_ts IS NOT NULL AND CAST(prev_ts AS DATE) = CAST(timestamp AS DATE)
    AND CASE WHEN isnan(open) OR isnan(prev_close) THEN FALSE
             WHEN prev_close = 0 THEN open <> 0
             ELSE abs((open - prev_close) / prev_close) > 0.05 END
),
qa_stats AS (
  SELECT pair, CAST(count(*) AS BIGINT) AS total_bars,
         CAST(count(*) - count(DISTINCT timestamp) AS BIGINT) AS duplicates,
         CAST(count(*) FILTER (WHERE {OHLC_BAD_SQL}) AS BIGINT) AS ohlc_failures,
         CAST(count(*) FILTER (WHERE volume <= 0) AS BIGINT) AS zero_volume,
         CAST(count(*) FILTER (WHERE bar_hash IS NULL) AS BIGINT) AS hash_nulls,
         min(timestamp) AS start_ts, max(timestamp) AS end_ts
  FROM qa GROUP BY pair
),
qa_expected AS (
  SELECT s.*, (SELECT CAST(count(*) AS BIGINT) FROM (
      SELECT unnest(generate_series(date_trunc('minute', s.start_ts), s.end_ts, INTERVAL 1 MINUTE)) AS m) mins
      WHERE NOT {closed('mins.m')}) AS expected
  FROM qa_stats s
)
"""


def qq(body: str) -> str:
    return BASE + BATCH_CTES + QA_CTES + body


ORACLE["qa_date_range"] = qq(
    f"SELECT pair, total_bars, {ISO.format(c='start_ts')} AS start, {ISO.format(c='end_ts')} AS \"end\" FROM qa_stats"
)
ORACLE["qa_duplicates"] = qq('SELECT pair, duplicates AS count, duplicates = 0 AS pass FROM qa_stats')
ORACLE["qa_ohlc"] = qq('SELECT pair, ohlc_failures AS failures, ohlc_failures = 0 AS pass FROM qa_stats')
ORACLE["qa_zero_volume"] = qq('SELECT pair, zero_volume AS count FROM qa_stats')
ORACLE["qa_sources"] = qq("SELECT pair, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM qa GROUP BY pair")
ORACLE["qa_hash_nulls"] = qq('SELECT pair, hash_nulls AS count, hash_nulls = 0 AS pass FROM qa_stats')
ORACLE["qa_yearly"] = qq(
    "SELECT pair, CAST(year(timestamp) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n FROM qa GROUP BY 1, 2"
)
ORACLE["qa_completeness"] = qq(
    "SELECT pair, CASE WHEN expected > 0 THEN round(total_bars / expected * 100, 2) ELSE 0.0 END AS percent, "
    "total_bars AS actual, expected FROM qa_expected"
)
ORACLE["qa_gaps"] = qq(
    f"SELECT pair, {ISO.format(c='from_ts')} AS \"from\", {ISO.format(c='to_ts')} AS \"to\", minutes FROM qa_gap_rows"
)
ORACLE["qa_spikes"] = qq("SELECT pair, timestamp, prev_close, open, pct_change FROM qa_spike_rows")
ORACLE["qa_gap_examples"] = qq(
    f"SELECT pair, CAST(row_number() OVER (PARTITION BY pair ORDER BY from_ts) AS INTEGER) AS rank, "
    f"{ISO.format(c='from_ts')} AS \"from\", {ISO.format(c='to_ts')} AS \"to\", minutes FROM qa_gap_rows "
    "QUALIFY rank <= 10"
)
ORACLE["qa_spike_examples"] = qq(
    "SELECT pair, timestamp, prev_close, open, pct_change, CAST(row_number() OVER (PARTITION BY pair "
    "ORDER BY timestamp, knowledge_time, bar_hash, open) AS INTEGER) AS rank "
    "FROM qa_spike_rows QUALIFY rank <= 10"
)


ORACLE["load_ticks"] = q("SELECT * EXCLUDE (event_id) FROM ticks")
ORACLE["slot_from_path"] = q(f"SELECT DISTINCT pair, slot, {SLOT_PARTS_SQL} FROM raw_ticks")
ORACLE["slot_outcome"] = qs("SELECT pair, year, month, day, hour, status FROM catalog")
ORACLE["incremental_load"] = qb(f"SELECT {STORE_COLS} FROM stamped WHERE NOT {BAD_SQL}")

ORACLE["instruments"] = q(
    "SELECT i.pair, i.pair_ord, i.point_value FROM instruments i "
    "WHERE i.pair IN (SELECT DISTINCT pair FROM raw_ticks)"
)

ORACLE["file_outcomes"] = q("""
, files AS (SELECT pair, slot, CAST(count(*) AS BIGINT) AS n, hour(slot) % 7 AS kind FROM raw_ticks GROUP BY 1, 2),
named AS (
  SELECT *, CASE kind WHEN 3 THEN 'X' || pair WHEN 5 THEN lower(pair) ELSE pair END AS folder,
         CASE kind WHEN 4 THEN 13 ELSE month(slot) END AS m FROM files
)
SELECT printf('%s/%d/%02d/%02d/%02dh_ticks.bi5', folder, year(slot), m, day(slot), hour(slot)) AS name,
       folder AS pair, CASE WHEN kind = 4 THEN NULL ELSE slot END AS slot,
       CASE WHEN kind IN (1, 3, 4, 5) THEN 'error' ELSE 'fetched' END AS status,
       CASE WHEN kind IN (1, 4) THEN 0 ELSE n END AS records,
       CAST(CASE kind WHEN 2 THEN 7 ELSE 0 END AS INTEGER) AS trailing,
       CASE kind WHEN 1 THEN 'lzma' WHEN 4 THEN 'unrecognised path' WHEN 3 THEN 'unknown pair' WHEN 5 THEN 'unknown pair' END AS error
FROM named
""")
ORACLE["ingest_loop"] = qs(
    "SELECT pair, pair_ord, slot, year, month, day, hour, CAST(0 AS BIGINT) AS decoded_again FROM pending"
)

FRACTIONAL = """,
frac AS (
  SELECT r.pair, r.slot, r.seq, t.timestamp, t.mid,
         CAST(CAST(r.ask_volume + (r.event_id % 10) / 10.0 AS FLOAT) AS DOUBLE)
         + CAST(CAST(r.bid_volume / 7.0 AS FLOAT) AS DOUBLE) AS vol
  FROM raw_ticks r JOIN ticks t ON t.event_id = r.event_id
),
fbars AS (
  SELECT pair, slot, date_trunc('minute', timestamp) AS timestamp,
         arg_min(mid, seq) AS open, max(mid) AS high, min(mid) AS low, arg_max(mid, seq) AS close,
         fsum(vol) AS volume, '{source}' AS source
  FROM frac GROUP BY 1, 2, 3
)
""".replace("{source}", DEFAULT_SOURCE)
ORACLE["fractional_bars"] = q(FRACTIONAL + f"SELECT pair, slot, timestamp, volume, {hash_sql()} AS bar_hash FROM fbars")
ORACLE["fractional_volumes"] = q(FRACTIONAL + "SELECT pair, slot, timestamp, volume FROM fbars")
ORACLE["storage_size"] = qb(f"""
SELECT 'raw' AS kind, CAST(count(*) AS BIGINT) AS n, 'true' AS agrees FROM (SELECT DISTINCT pair, slot FROM raw_ticks)
UNION ALL
SELECT 'bars', CAST(count(*) AS BIGINT), 'true' FROM (SELECT DISTINCT pair, year(timestamp) FROM stamped WHERE NOT {BAD_SQL})
""")

ORACLE["qa_report"] = qq(f"""
, g AS (SELECT pair, CAST(count(*) AS BIGINT) AS n FROM qa_gap_rows GROUP BY pair)
, sp AS (SELECT pair, CAST(count(*) AS BIGINT) AS n FROM qa_spike_rows GROUP BY pair)
, src AS (SELECT pair, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM qa GROUP BY pair)
, yr AS (
  SELECT pair, string_agg(k, ',' ORDER BY k) AS yearly FROM (
    SELECT pair, CAST(year(timestamp) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR) AS k
    FROM qa GROUP BY pair, year(timestamp)) GROUP BY pair
)
, gr AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY from_ts) AS rank FROM qa_gap_rows)
, gx AS (
  SELECT pair, string_agg({ISO.format(c='from_ts')} || '/' || {ISO.format(c='to_ts')} || '/' || minutes, ',' ORDER BY rank) AS examples
  FROM gr WHERE rank <= 10 GROUP BY pair
)
, sr AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY timestamp, knowledge_time, bar_hash, open) AS rank FROM qa_spike_rows)
, sx AS (
  SELECT pair, string_agg({ISO.format(c='timestamp')} || '/' || CAST(round(prev_close * 1000000) AS BIGINT) || '/'
                          || CAST(round(open * 1000000) AS BIGINT) || '/' || CAST(round(pct_change * 1000000) AS BIGINT), ',' ORDER BY rank) AS examples
  FROM sr WHERE rank <= 10 GROUP BY pair
)
SELECT i.pair,
       CASE WHEN s.pair IS NULL THEN 'no_data' ELSE 'ok' END AS status,
       coalesce(s.total_bars, 0) AS total_bars,
       {ISO.format(c='s.start_ts')} AS start, {ISO.format(c='s.end_ts')} AS "end",
       coalesce(s.duplicates, 0) AS duplicates, CAST(s.duplicates = 0 AS VARCHAR) AS duplicates_pass,
       coalesce(s.ohlc_failures, 0) AS ohlc_failures, CAST(s.ohlc_failures = 0 AS VARCHAR) AS ohlc_pass,
       coalesce(s.zero_volume, 0) AS zero_volume,
       coalesce(g.n, 0) AS gap_count,
       gx.examples AS gap_examples,
       CASE WHEN s.expected > 0 THEN round(s.total_bars / s.expected * 100, 2) ELSE 0.0 END AS completeness_percent,
       coalesce(s.total_bars, 0) AS completeness_actual, coalesce(s.expected, 0) AS completeness_expected,
       src.sources,
       coalesce(s.hash_nulls, 0) AS hash_nulls, CAST(s.hash_nulls = 0 AS VARCHAR) AS hash_pass,
       coalesce(sp.n, 0) AS spike_count,
       sx.examples AS spike_examples,
       yr.yearly AS yearly_row_counts
FROM instruments i
LEFT JOIN qa_expected s ON s.pair = i.pair
LEFT JOIN g ON g.pair = i.pair
LEFT JOIN sp ON sp.pair = i.pair
LEFT JOIN gx ON gx.pair = i.pair
LEFT JOIN sx ON sx.pair = i.pair
LEFT JOIN src ON src.pair = i.pair
LEFT JOIN yr ON yr.pair = i.pair
""")
ORACLE["qa_report_kept"] = ORACLE["qa_report"]  # however the days were made
ORACLE["qa_report_json"] = (
    "SELECT *, strftime(TIMESTAMP '" + KNOWLEDGE_TIME_2 + "', '%Y-%m-%dT%H:%M:%S.%f+00:00') AS generated_at FROM ("
    + ORACLE["qa_report"] + ")"
)
