"""Merkle manifest by a nested-struct rollup.

Leaves of a group (a source) are numbered by key. A number's base-16 digits
place the leaf in the tree: its last three digits are grouped away one after
another, each grouping turning up to 16 children into one node that holds the
node's digest and, nested, the children themselves. That ends at blocks of
``BLOCK`` leaves, so no row outgrows that bound. Blocks' digests are the leaves
of the next stage, until each group has one block, and the groups' subroots, in
order, are rolled up the same way to the root.

Proofs come from the nested rows alone. From the topmost stage down, a block
and the path of its own node (which has reached it as one more row of its
group) are opened digit by digit; each child leaves with its siblings set
before that path. There is no join along the tree: digits are shuffled once a
stage, by block, and all three groupings run in that partitioning.

Digests and paths are column expressions; numbering is ``running``, so no
group is sorted or gathered in one task.

Defined results: a null key comes first in its group, rows of equal keys follow
each other by digest; a null group is a group and comes first. Null fields are
told from all values. A lone leaf is its group's subroot, a lone subroot the
root. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import written
from tickweave.llm.running import running

ARITY = 16
DIGITS = 3
BLOCK = ARITY**DIGITS
#: Characters of a digest.
HEX = 64
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a record: each field as its size, a colon and its text; a dash for null."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _digit(k: int) -> Column:
    return F.shiftright("rank", 4 * k).bitwiseAND(F.lit(ARITY - 1)).cast("int")


def roll_up(nodes: DataFrame, name: str) -> DataFrame:
    """Blocks (grp, n, block, hash, kids) of the nodes (grp, n, rank, hash, item):
    ``n`` nodes of each group, numbered from 0 without a gap. Written."""
    rows = nodes.select("grp", "n", F.shiftright("rank", 4 * DIGITS).alias("block"), *[_digit(k).alias(f"d{k}") for k in range(DIGITS)], "hash", F.col("item").alias("kids"))
    rows = rows.repartition("grp", "block")
    for k in range(DIGITS):
        digits = [f"d{i}" for i in range(k + 1, DIGITS)]
        rows = rows.groupBy("grp", "n", "block", *digits).agg(F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("d"), "hash", "kids"))).alias("kids"))
        # one node alone in its group is taken as it is; a lone last child of many nodes is hashed
        both = digest(F.array_join(F.transform("kids", lambda x: x["hash"]), ""))
        rows = rows.withColumn("hash", F.when(F.col("n") > ARITY**k, both).otherwise(F.col("kids")[0]["hash"]))
    return written(rows.select("grp", "n", "block", "hash", "kids"), name)[0]


def open_up(blocks: DataFrame, carry: list[str]) -> DataFrame:
    """The nodes within blocks that know their ``path``: (grp, rank, hash, item, path, *carry)."""
    rows = blocks.select("grp", "n", F.col("block").alias("rank"), "kids", "path", *carry)
    for k in reversed(range(DIGITS)):
        rows = rows.withColumn("all", F.array_join(F.transform("kids", lambda x: x["hash"]), ""))
        rows = rows.select("grp", "n", "rank", "all", "path", *carry, F.posexplode("kids").alias("at", "kid"))
        side = F.struct(
            F.left("all", F.col("at") * HEX).alias("left"),
            F.substring("all", (F.col("at") + 1) * HEX + 1, F.octet_length("all")).alias("right"))
        rows = rows.select(
            "grp", "n", (F.shiftleft("rank", 4) + F.col("kid.d")).alias("rank"), F.col("kid.hash").alias("hash"), F.col("kid.kids").alias("kids"),
            F.when(F.col("n") > ARITY**k, F.concat(F.array(side), "path")).otherwise(F.col("path")).alias("path"), *carry)
    return rows.select("grp", "rank", "hash", F.col("kids").alias("item"), "path", *carry)


def climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Block tables of all stages, lowest first; the last has one block a group."""
    stages = []
    while True:
        blocks = roll_up(nodes, f"{name}-{len(stages)}")
        stages.append(blocks)
        if blocks.filter("block > 0").isEmpty():
            return stages
        many = F.ceil(F.col("n") / BLOCK).cast("long")
        nodes = blocks.select("grp", many.alias("n"), F.col("block").alias("rank"), "hash", F.lit(None).cast("int").alias("item"))


def descend(stages: list[DataFrame], tops: DataFrame, carry: list[str]) -> DataFrame:
    """The lowest stage's nodes (grp, rank, hash, item, path, *carry). ``tops``
    (grp, path, *carry) has what every group's top node gets."""
    known = tops.select("grp", F.lit(0).cast("long").alias("block"), "path", *carry)
    for level, blocks in reversed(list(enumerate(stages))):
        # the path of a block comes to it as one more row of its group
        body, told = F.struct("n", "kids"), F.struct("path", *carry)
        rows = blocks.select("grp", "block", body.alias("body")).unionByName(known.select("grp", "block", told.alias("told")), allowMissingColumns=True)
        rows = rows.groupBy("grp", "block").agg(F.first("body", ignorenulls=True).alias("body"), F.first("told", ignorenulls=True).alias("told"))
        nodes = open_up(rows.select("grp", "block", "body.*", "told.*"), carry)
        known = nodes if level == 0 else nodes.select("grp", F.col("rank").alias("block"), "path", *carry)
    return known


def manifest(docs: DataFrame, leaf: Column, group: str, key: str, carry: dict[str, Column]) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, leaf, subroot, root and
    ``proof``, the siblings to the left and right of the path, bottom up."""
    item = F.struct(*[c.alias(name) for name, c in carry.items()])
    rows, _ = written(docs.select(F.col(group).cast("string").alias("grp"), F.col(key).alias("key"), leaf.alias("hash"), item.alias("item")), "merkle-leaves")
    rows = running(rows, {"grp": F.col("grp")}, [F.col("key"), F.col("hash")], F.lit(1), "merkle-rank")
    nodes = lambda df: df.select("grp", F.col("whole").alias("n"), (F.col("upto") - 1).alias("rank"), "hash", "item")
    within = climb(nodes(rows), "merkle-blocks")
    # group names are items of one group of groups
    subroots = within[-1].select(F.col("grp").alias("item"), "hash")
    subroots = running(subroots, {"grp": F.lit(0)}, [F.col("item")], F.lit(1), "merkle-groups")
    across = climb(nodes(subroots), "merkle-subroots")
    top = across[-1].select("grp", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    tops = descend(across, top, ["root"]).select(F.col("item").alias("grp"), "path", F.col("hash").alias("subroot"), "root")
    out = descend(within, tops, ["subroot", "root"])
    return out.select(*[F.col("item").getField(c).alias(c) for c in carry], F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"))


def siblings(proof: Column) -> Column:
    """All siblings of a proof in one text, bottom up, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its proof make."""
    return F.aggregate(proof, leaf, lambda acc, p: digest(p["left"], acc, p["right"]))
