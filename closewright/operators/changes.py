"""What changed between two states of a table: a tree of digests over fixed key ranges, compared from the root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.operators.evidence import DIGEST, row_digest

RANGE = "digest_range"
#: Levels below the root and children of a node: ranges are FANOUT ** LEVELS at most.
LEVELS, FANOUT = 3, 16
_SUMS = ("s0", "s1", "s2", "s3")


def range_of(df: DataFrame, keys: Sequence[str], width: int | None = None) -> Column:
    """The fixed range of a row: of one whole-number key `width` consecutive values share a range, else a hash of the keys decides.

    Ranges wrap round after FANOUT ** LEVELS of them, so their number is fixed whatever the keys. Null keys are a range
    by their hash.
    """
    ranges = FANOUT**LEVELS
    if width is not None and len(keys) == 1:
        return F.coalesce(F.pmod(F.floor(F.col(keys[0]) / width), F.lit(ranges)), F.lit(0)).cast("int")
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def write_by_range(df: DataFrame, path: str, keys: Sequence[str], width: int | None = None) -> None:
    """The table in one folder per range, so that single ranges can be read again."""
    df.withColumn(RANGE, range_of(df, keys, width)).hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(path)


def read_by_range(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def digest_tree(df: DataFrame, keys: Sequence[str], width: int | None = None) -> DataFrame:
    """level, node, data_rows and digest of every node that holds rows; level 0 is the root.

    A row's digest is four 32-bit parts of its SHA-256, and a node's their sums over its rows, so order and partitioning
    do not count, duplicates do, and one pass makes the leaves, from which all other levels follow.
    """
    at = F.col(RANGE) if RANGE in df.columns else range_of(df, keys, width)
    plain = df.drop(RANGE)
    rows = df.select(at.alias("node"), row_digest(plain).alias(DIGEST))
    parts = [F.conv(F.substring(DIGEST, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)") for i in range(4)]
    leaves = rows.groupBy("node").agg(F.count("*").alias("data_rows"), *[F.sum(p).alias(s) for p, s in zip(parts, _SUMS, strict=True)])
    ancestors = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("node") / FANOUT ** (LEVELS - level)).cast("int").alias("node")) for level in range(LEVELS + 1)])
    each = leaves.select(F.explode(ancestors).alias("at"), "data_rows", *_SUMS)
    summed = each.groupBy("at.level", "at.node").agg(F.sum("data_rows").alias("data_rows"), *[F.sum(s).alias(s) for s in _SUMS])
    return summed.select("level", "node", "data_rows", F.sha2(F.concat_ws("|", *[F.col(s).cast("string") for s in _SUMS]), 256).alias("digest"))


def differing_ranges(old: DataFrame, new: DataFrame) -> list[int]:
    """Ranges whose digests differ between two trees. From the root, nodes count only below nodes that differ.

    One job compares all nodes, so a tree that is not stored is made once. What comes to the driver is at most the nodes
    of a tree.
    """
    one, two = (t.select("level", "node", F.struct("data_rows", "digest").alias(name)) for t, name in ((old, "a"), (new, "b")))
    differ = {tuple(r) for r in one.join(two, ["level", "node"], "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("level", "node").collect()}
    wanted = [0]
    for level in range(LEVELS + 1):
        found = sorted(n for n in wanted if (level, n) in differ)
        wanted = [n * FANOUT + k for n in found for k in range(FANOUT)]
    return found


def changed_rows(old: DataFrame, new: DataFrame, old_tree: DataFrame, new_tree: DataFrame, keys: Sequence[str], width: int | None = None) -> DataFrame:
    """Keys, range and change (added, lost or changed) of what differs; only differing ranges of both tables are read.

    Tables written by `write_by_range` are read in those folders only. Rows of one key are compared together: a key whose
    rows are as many and as they were has not changed; equal rows more or fewer than before have.

    Of a row only its key and 128 bits of its digest move, together with its equals of both tables; then a key moves once
    for all its rows.
    """
    ranges = differing_ranges(old_tree, new_tree)
    stored = RANGE in old.columns or RANGE in new.columns

    key = [f"key_{i}" for i in range(len(keys))]

    def told(df: DataFrame, is_new: bool) -> DataFrame:
        at = F.col(RANGE) if RANGE in df.columns else range_of(df, keys, width)
        sides = [F.lit(int(side == is_new)).cast("long").alias(name) for side, name in ((False, "old_rows"), (True, "new_rows"))]
        named = [F.col(k).alias(name) for k, name in zip(keys, key, strict=True)]
        digest = F.unhex(F.substring(row_digest(df.drop(RANGE)), 1, 32)).alias(DIGEST)
        return df.filter(at.isin(ranges) if ranges else F.lit(False)).select(*named, digest, *sides, *([at.alias("range")] if stored else []))

    # A range that is not stored follows from the key afterwards, so it need not move.
    of_row = [*key, DIGEST, *(["range"] if stored else [])]
    equals = told(old, False).union(told(new, True)).groupBy(*of_row).agg(F.sum("old_rows").alias("old_rows"), F.sum("new_rows").alias("new_rows"))
    was, is_now = F.col("old_rows") > 0, F.col("new_rows") > 0
    ranged = [F.coalesce(F.max(F.when(was, F.col("range"))), F.max("range")).alias("range")] if stored else []
    of_key = equals.groupBy(*key).agg(F.max(was).alias("was"), F.max(is_now).alias("is_now"), F.max(F.col("old_rows") != F.col("new_rows")).alias("differs"), *ranged)
    change = F.when(~F.col("was"), "added").when(~F.col("is_now"), "lost").otherwise("changed")
    at = F.col("range") if stored else range_of(of_key, key, width)
    return of_key.filter("differs").select(*[F.col(name).alias(k) for k, name in zip(keys, key, strict=True)], at.alias("range"), change.alias("change"))
