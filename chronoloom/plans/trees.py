"""Tree fingerprints of groups of any size, and comparison by descent.

A row's hash places it in a leaf: the first `depth` hexadecimal digits. A leaf's hash is that of its distinct row hashes
in order, each with its count; an inner node's is that of its children's digits and hashes in order, sixteen at most. Rows
and leaves of one group are spread over tasks, repeated rows are counted before they are moved, and nothing longer than a
leaf's list is ever gathered. With a depth by `depth_for` a leaf has some hundreds of rows, however large the group; what is
compared must have one depth.

Two trees are compared from the roots down: on each level only children of nodes that differ are looked at, and rows are
read only for the leaves that are left.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.plans.reconcile import row_text

LEAF = 256
COLUMNS = ("timeseries_id", "observed_at", "value")


def depth_for(*sides: DataFrame, keys: list[str], leaf: int = LEAF) -> int:
    """The depth at which leaves of the largest group of any side have about `leaf` rows."""
    most = max(df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0 for df in sides)
    return max(0, math.ceil(math.log(max(most, 1) / leaf, 16))) if most > leaf else 0


def row_hashes(rows: DataFrame, keys: list[str], depth: int, columns=COLUMNS) -> DataFrame:
    """(keys, prefix, h, c): the distinct rows of a group and how often each occurs."""
    hashed = rows.select(*keys, F.sha2(row_text(columns), 256).alias("h")).groupBy(*keys, "h").agg(F.count("*").alias("c"))
    return hashed.withColumn("prefix", F.substring("h", 1, depth) if depth else F.lit(""))


def _hash(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items), "\n"), 256)


def leaves(rows: DataFrame, keys: list[str], depth: int, columns=COLUMNS) -> DataFrame:
    """(keys, level, prefix, n, hash) of the leaves."""
    each = F.concat_ws(":", "h", F.col("c").cast("string"))
    return row_hashes(rows, keys, depth, columns).groupBy(*keys, "prefix").agg(F.sum("c").alias("n"), _hash(F.collect_list(each)).alias("hash")).select(*keys, F.lit(depth).alias("level"), "prefix", "n", "hash")


def parents(nodes: DataFrame, keys: list[str], level: int) -> DataFrame:
    """The nodes of a level from their children, those of the next."""
    child = F.concat(F.substring("prefix", level + 1, 1), F.lit(":"), "hash")
    up = nodes.groupBy(*keys, F.substring("prefix", 1, level).alias("up") if level else F.lit("").alias("up"))
    return up.agg(F.sum("n").alias("n"), _hash(F.collect_list(child)).alias("hash")).select(*keys, F.lit(level).alias("level"), F.col("up").alias("prefix"), "n", "hash")


def tree(rows: DataFrame, keys: list[str], depth: int, columns=COLUMNS) -> DataFrame:
    """All nodes (keys, level, prefix, n, hash), the root at level 0. Written partitioned by level, a comparison reads the
    levels that it needs."""
    levels = [leaves(rows, keys, depth, columns)]
    for level in range(depth - 1, -1, -1):
        levels.append(parents(levels[-1], keys, level))
    return reduce(DataFrame.unionByName, levels)


def roots(rows: DataFrame, keys: list[str], depth: int, prefix: str = "", columns=COLUMNS) -> DataFrame:
    """(keys, n, fingerprint): the roots alone, under a prefix that names the kind of data and its version."""
    nodes = leaves(rows, keys, depth, columns)
    for level in range(depth - 1, -1, -1):
        nodes = parents(nodes, keys, level)
    return nodes.select(*keys, "n", F.sha2(F.concat(F.lit(prefix), "hash"), 256).alias("fingerprint"))


def _both(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    side = lambda df, s: df.select(*on, F.col("n").alias(f"n_{s}"), F.col("hash").alias(f"hash_{s}"))
    return side(a, "a").join(side(b, "b"), on, "full_outer").filter(~F.col("hash_a").eqNullSafe(F.col("hash_b")))


def differing_leaves(a: DataFrame, b: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """(keys, prefix, n_a, n_b) of leaves that differ between two trees, found by descent. keys are not null."""
    on = [*keys, "prefix"]
    found = _both(a.filter("level = 0"), b.filter("level = 0"), on)
    for level in range(1, depth + 1):
        up = found.select(*keys, F.col("prefix").alias("__up"))
        below = lambda df: df.filter(F.col("level") == level).withColumn("__up", F.substring("prefix", 1, level - 1) if level > 1 else F.lit("")).join(up, [*keys, "__up"], "left_semi")  # noqa: B023, E731
        found = _both(below(a), below(b), on)
    return found.select(*on, "n_a", "n_b")


def differing_rows(rows_a: DataFrame, rows_b: DataFrame, differing: DataFrame, keys: list[str], depth: int, columns=COLUMNS) -> DataFrame:
    """(keys, columns, n_a, n_b, result) of the rows that two sides hold unlike often, from the differing leaves alone."""
    def part(rows, side):
        placed = rows.select(*dict.fromkeys([*keys, *columns]), F.sha2(row_text(columns), 256).alias("h")).withColumn("prefix", F.substring("h", 1, depth) if depth else F.lit(""))
        near = placed.join(differing.select(*keys, "prefix"), [*keys, "prefix"], "left_semi")
        shown = [F.first(c).alias(f"{c}_{side}") for c in columns if c not in keys]
        return near.groupBy(*keys, "h").agg(F.count("*").alias(f"n_{side}"), *shown)

    both = part(rows_a, "a").join(part(rows_b, "b"), [*keys, "h"], "full_outer").withColumns({"n_a": F.coalesce("n_a", F.lit(0)), "n_b": F.coalesce("n_b", F.lit(0))}).filter("n_a <> n_b")
    result = F.when(F.col("n_b") == 0, "missing_in_b").when(F.col("n_a") == 0, "extra_in_b").otherwise("count_differs")
    return both.select(*keys, *[F.coalesce(f"{c}_a", f"{c}_b").alias(c) for c in columns if c not in keys], "n_a", "n_b", result.alias("result"))


def identity_states(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_now, n_before, state) of source identities, roots of a day each: same, changed, new or gone; a change that
    kept the number of rows is told apart, as counts would miss it."""
    side = lambda df, s: df.select(*keys, F.col("n").alias(f"n_{s}"), F.col("fingerprint").alias(f"f_{s}"))
    both = side(now, "now").join(side(before, "before"), keys, "full_outer")
    state = (
        F.when(F.col("f_before").isNull(), "new").when(F.col("f_now").isNull(), "gone").when(F.col("f_now") == F.col("f_before"), "same")
        .when(F.col("n_now") == F.col("n_before"), "changed_with_equal_count").otherwise("changed")
    )
    return both.select(*keys, "n_now", "n_before", state.alias("state"))
