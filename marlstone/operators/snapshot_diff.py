"""What changed between consecutive full snapshots, by Merkle trees over key ranges.

Keys are hashed into 2^depth equal ranges (leaves), the depth taken from the number of keys so that a leaf holds a
few. A leaf's digest sums up the hashes of its rows, a parent's those of its children, up to one root per
snapshot. Two snapshots are compared from the root down: only children of nodes
that differ are looked at, and only rows in leaves that differ are compared.

`digest` writes row hashes and trees once; given those of earlier snapshots it adds to them, reading no row of
theirs, and `diff` can be limited to what came since.

A digest is the row count and the exclusive or of two independently seeded 64-bit row
hashes; keys are unique by then, so no two rows cancel out, and equal digests of
unequal rows have a chance of about 2^-128.

Of several rows of one key the one with the greatest `order` counts (ties: the
greatest row hash). Rows with a null key or snapshot are ignored; nulls in
other columns are values, equal to each other. An empty table, or a single
snapshot, gives no changes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marlstone.session import materialise, observed, sized

FANOUT_BITS = 5
ROWS_PER_LEAF = 16
MOST_BITS = 40


def normalised(df: DataFrame, snapshot: Column, key: Column, values: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """snapshot, key, at (the hash of the key), h1, h2: one row per key and snapshot.

    One aggregation of row hashes, partial before its shuffle, so that a key repeated in
    a third of all rows reaches one task only once per map task.
    """
    parts = [x for v in values for x in (v.isNull(), v)]
    hashes = [F.xxhash64(F.lit(seed), key, *parts).alias(h) for h, seed in (("h1", 11), ("h2", 8191))]
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *hashes)
    out = df.select(snapshot.alias("snapshot"), key.alias("key"), row.alias("row")).where("snapshot is not null and key is not null")
    out = out.groupBy("snapshot", "key").agg(F.max("row").alias("row"))
    return out.select("snapshot", "key", F.xxhash64("key").alias("at"), "row.h1", "row.h2")


def depth_for(keys: int) -> int:
    """A multiple of the fan-out with about ROWS_PER_LEAF keys, or fewer, in a leaf."""
    bits = math.log2(max(2.0, keys / ROWS_PER_LEAF))
    return min(MOST_BITS, FANOUT_BITS * max(1, math.ceil(bits / FANOUT_BITS)))


def leaf(depth: int) -> Column:
    return F.shiftrightunsigned("at", 64 - depth).cast("long")


def trees(rows: DataFrame, depth: int) -> DataFrame:
    """level (0 is the root), snapshot, node, n, d1, d2: every node of every snapshot's tree.

    Rows are summed up to leaves before the one shuffle of rows; the levels above climb from the leaves.
    """
    sums = [F.bit_xor(c).alias(c) for c in ("d1", "d2")]
    low = rows.select("snapshot", leaf(depth).alias("leaf"), F.col("h1").alias("d1"), F.col("h2").alias("d2")).groupBy("snapshot", "leaf").agg(F.count(F.lit(1)).alias("n"), *sums)
    top = depth // FANOUT_BITS
    path = F.array(*[F.struct(F.lit(top - k).alias("level"), F.shiftright("leaf", FANOUT_BITS * k).alias("node")) for k in range(top + 1)])
    return low.select("snapshot", F.inline(path).alias("level", "node"), "n", "d1", "d2").groupBy("level", "snapshot", "node").agg(F.sum("n").alias("n"), *sums)


@dataclass(frozen=True)
class Digested:
    """Written row hashes and trees of some snapshots, and their list, one entry per delivery."""

    rows: DataFrame
    trees: DataFrame
    depth: int
    names: tuple


def digest(rows: DataFrame, depth: int | None = None, earlier: Digested | None = None) -> Digested:
    """Hashes and trees of `normalised` rows. With `earlier`, whose depth it takes, those are kept as they are."""
    seen = Observation()
    written = materialise(rows.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set("snapshot").alias("names")), "snapshot-rows")
    counted = observed(seen)
    names = sorted(counted.get("names") or [])
    if earlier is not None:
        depth = earlier.depth
    elif depth is None:
        depth = depth_for(counted.get("n", 0) // max(1, len(names)))
    nodes = materialise(trees(written, depth), "snapshot-trees")
    if earlier is None:
        return Digested(written, nodes, depth, tuple(names))
    if set(names) & set(earlier.names):
        raise ValueError("a snapshot was digested before")
    return Digested(earlier.rows.unionByName(written), earlier.trees.unionByName(nodes), depth, tuple(sorted((*earlier.names, *names))))


def _sides(names: Sequence) -> Column:
    """array of struct(later, s): the comparisons a snapshot's row takes part in, as the later (1) and as the earlier side (-1)."""
    following = F.create_map(*[F.lit(x) for pair in zip(names, names[1:], strict=False) for x in pair])
    snapshot = F.col("snapshot")
    now = F.when(snapshot != F.lit(names[0]), F.struct(snapshot.alias("later"), F.lit(1).alias("s")))
    then = F.when(F.try_element_at(following, snapshot).isNotNull(), F.struct(F.try_element_at(following, snapshot).alias("later"), F.lit(-1).alias("s")))
    return F.array_compact(F.array(now, then))


def differing_leaves(nodes: DataFrame, depth: int, names: Sequence) -> DataFrame:
    """later, node: top-down, following only nodes whose digests differ."""
    open_nodes = None
    for level in range(depth // FANOUT_BITS + 1):
        # both versions of a node meet in one aggregation; one that is absent differs by its count
        both = nodes.where(F.col("level") == level).select("node", "n", "d1", "d2", F.inline(_sides(names)).alias("later", "s"))
        if open_nodes is not None:
            both = both.withColumn("parent", F.shiftright("node", FANOUT_BITS)).join(sized(open_nodes.withColumnRenamed("node", "parent")), ["later", "parent"], "left_semi")
        sums = [F.sum(F.col("n") * F.col("s")).alias("n"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2")]
        # written down, so the levels below read a few nodes instead of planning all levels above again
        open_nodes = materialise(both.groupBy("later", "node").agg(*sums).where("n != 0 or d1 != 0 or d2 != 0").select("later", "node"), "differing")
    return open_nodes


def diff(of: Digested, since=None) -> DataFrame:
    """snapshot (the later one), key, change: added, removed or changed; with `since`, of the snapshots after that one."""
    names = of.names if since is None else tuple(n for i, n in enumerate(of.names) if n > since or (i + 1 < len(of.names) and of.names[i + 1] > since))
    if len(names) < 2:
        return of.rows.select("snapshot", "key", F.lit("changed").alias("change")).limit(0)
    wanted = F.col("snapshot").isin(*names)
    found = differing_leaves(of.trees.where(wanted), of.depth, names).withColumnRenamed("node", "leaf")
    sides = of.rows.where(wanted).select(leaf(of.depth).alias("leaf"), "key", "h1", "h2", F.inline(_sides(names)).alias("later", "s"))
    met = sides.join(sized(found), ["later", "leaf"], "left_semi").groupBy("later", "key").agg(F.sum("s").alias("s"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    change = F.when(F.col("s") > 0, "added").when(F.col("s") < 0, "removed").when((F.col("x1") != 0) | (F.col("x2") != 0), "changed")
    return met.select(F.col("later").alias("snapshot"), "key", change.alias("change")).where("change is not null")
