"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints of 64 bits link when ``RADIUS`` or fewer bits differ. Each bit
position i gets a non-zero vector m(i) of RADIUS + 1 bits; for every non-zero
vector v of that length there is a table that compares the positions with
<m(i), v> odd. Up to RADIUS differing positions span less than the whole space,
so some v is orthogonal to all their vectors: in that table the pair agrees
(no pair is missed; the tables are fixed, not drawn).

Only distinct fingerprints are compared. A bucket of two is decided by one
built-in expression. Larger ones, up to ``BUCKET``, are searched in one task,
breadth first, and give a spanning forest of their links, never all pairs.
Buckets beyond that are split by a second and third covering of the positions
that they do not yet share; after three at most 12 positions are free, so no
bucket can exceed 2**12 fingerprints. Links become components by alternating
large-star and small-star rounds over written tables.

Defined results: null text is the empty text; a text without words has
fingerprint zero and links like any other. Rows with a null id get their
component's smallest non-null id, or null if there is none. Repeated rows and
ids each give one row; ``near_dedup`` keeps exactly one row of a group. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import forget, text_of, written

SHINGLE = 3
RADIUS = 3
BITS = 64
#: Fingerprints that one task may compare at a time.
BUCKET = 4096
SEED = 42


def positions(level: int) -> list[int]:
    """m(i) of the given covering. Each deals out anew the positions that the
    one before leaves together: 32, 19 and 12 at most stay free."""
    n = 2 ** (RADIUS + 1) - 1
    return [1 + (i, i * 8 + i // 5, i * 6 + i // 5)[level] % n for i in range(BITS)]


def masks(level: int) -> list[int]:
    """The compared positions of each table, as 64-bit masks."""
    m = positions(level)
    return [sum(1 << i for i in range(BITS) if bin(m[i] & v).count("1") % 2) for v in range(1, 2 ** (RADIUS + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_TABLE = np.array([[(b >> i) & 1 for i in range(8)] for b in range(256)], dtype=np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, splits at 9-13 and 32
    if not words:
        return 0
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate(([0], ends[: len(words) - shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], dtype=np.uint64)
    octets = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _TABLE for k in range(8)])
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, carry: Sequence[Column] = ()) -> DataFrame:
    """(id, fp) and the columns ``carry``: fp as a signed 64-bit number."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        seen: dict[str, int] = {}
        out = []
        for t in texts:
            if t not in seen:
                seen[t] = _signed(fingerprint(t, shingle))
            out.append(seen[t])
        return pd.Series(out, dtype="int64")

    return docs.select(F.col(doc_id).alias("id"), fp(text_of(text)).alias("fp"), *carry)


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the given fingerprints."""
    left, edges = fps, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found, left = left[near], left[~near]
                edges += [(int(x), int(y)) for y in found]
                queue.extend(found)
    return edges


def _bucket_links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (t, key); buckets may run over from one frame to the next."""
    kept: list[np.ndarray] = []
    last = None
    edges: list[tuple[int, int]] = []

    def close() -> None:
        if kept:
            edges.extend(forest(np.concatenate(kept).view(np.uint64), RADIUS))

    for frame in frames:
        t, key, fp = (frame[c].to_numpy() for c in ("t", "key", "fp"))
        if not len(fp):
            continue
        cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
            if (here := (t[a], key[a])) != last:
                close()
                kept, last = [], here
            kept.append(fp[a:b])
        if edges:
            yield _edge_frame(edges)
            edges.clear()
    close()
    if edges:
        yield _edge_frame(edges)


def _edge_frame(edges: list[tuple[int, int]]) -> pd.DataFrame:
    a = np.array(edges, dtype=np.uint64).view(np.int64)
    return pd.DataFrame({"u": a.max(axis=1), "v": a.min(axis=1)}).drop_duplicates()


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) that connect what links connect, over distinct ``fp``."""
    spark = distinct.sparkSession
    found = []
    rows = distinct.select("fp", F.lit(0).alias("t"), F.lit(0).cast("long").alias("shared"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    for level in range(3):
        tables = F.explode(F.array(*[
            F.struct((F.col("t") * 16 + v).alias("t"), F.col("shared").bitwiseOR(F.lit(_signed(m))).alias("shared")) for v, m in enumerate(masks(level), 1)]))
        rows = rows.select("fp", tables.alias("x")).select("fp", "x.t", "x.shared", F.col("fp").bitwiseAND(F.col("x.shared")).alias("key"))
        sizes, sizes_path = written(
            rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.max("fp").alias("u"), F.min("fp").alias("v")).filter("n > 1"), "buckets")
        pairs = sizes.filter("n = 2").filter(near).select("u", "v")
        full, _ = written(rows.join(sizes.filter("n > 2").select("t", "key", "n").hint("merge"), ["t", "key"]).select("t", "key", "shared", "fp", "n"), "members")
        small = full.filter(F.col("n") <= bucket) if level < 2 else full
        more = (small.select("t", "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key").mapInPandas(_bucket_links, "u long, v long"))
        step, _ = written(pairs.unionByName(more), "links")
        found.append(step)
        forget(spark, sizes_path)
        rows = full.filter(F.col("n") > bucket).select("fp", "t", "shared")
        if level == 2 or rows.isEmpty():
            break
    out = found[0]
    for step in found[1:]:
        out = out.unionByName(step)
    return out


def _local_forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each frame's edges as stars around the smallest node they connect."""
    for frame in frames:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        for a, b in zip(frame["u"].tolist(), frame["v"].tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        if root:
            nodes = list(root)
            yield pd.DataFrame({"u": nodes, "v": [find(x) for x in nodes]})


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not its component's smallest, with the smallest."""
    spark = edges.sparkSession
    stars, path = written(edges.filter("u <> v").distinct().mapInPandas(_local_forest, "u long, v long").filter("u <> v").distinct(), "stars")
    mark = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == now:
            return stars
        mark = now
        for large in (True, False):
            if large:  # neighbours larger than the node move to the smallest one near it
                near = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
            else:  # the node and its smaller neighbours move to the smallest of them
                near = stars
            least, least_path = written(near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
            moved = near.join(least.hint("merge"), "u")
            moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else (
                moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))
            moved, moved_path = written(moved.filter("u <> v").distinct(), "stars")
            forget(spark, path, least_path)
            stars, path = moved, moved_path


def labels(fps: DataFrame) -> DataFrame:
    """(fp, root, component) of every distinct ``fp``: the smallest fingerprint
    and the smallest id reachable. ``fps`` is a written table (id, fp, ..)."""
    stars = components(links(fps.select("fp").distinct())).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    least, _ = written(fps.groupBy("fp").agg(F.min("id").alias("least")).join(stars, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"), "fp-roots")
    ids, _ = written(least.groupBy("root").agg(F.min("least").alias("component")), "components")
    return written(least.join(ids, "root").select("fp", "root", "component"), "fp-components")[0]


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, component) of every row: component is the smallest id reachable."""
    fps, _ = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    return fps.join(labels(fps).hint("merge"), "fp").select("id", "fp", "component")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints; same columns.

    Rows go by their place in a written table, not by their id: of a group the
    row of the smallest id stays (null ids last), of several such rows exactly
    one. A row whose id also stands in another group is not touched by that."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows, _ = written(fingerprints(docs, doc_id, text, carry=[whole]).withColumn("place", F.monotonically_increasing_id()), "near-rows")
    at = rows.select("id", "fp", "place")
    groups, _ = written(at.join(labels(at).select("fp", "root").hint("merge"), "fp").select("root", "id", "place"), "near-places")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "place")
    stay = groups.groupBy("root").agg(F.min(rank)["place"].alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("root", "stays")
    gone, _ = written(groups.join(stay.hint("merge"), "root").filter("place <> stays").select("place"), "near-gone")
    left = rows.join(gone.hint("merge"), "place", "left_anti")
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
