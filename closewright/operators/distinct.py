"""Exact distinct counts of several columns in one pass, as bitmaps over dense numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.sources.staging import staged


def numbers_of(values: DataFrame, column: str) -> DataFrame:
    """value and number of each distinct non-null value of a column, numbered from 0 without gaps over any number of tasks.

    Such a dictionary is made once for a column and kept; new values may be appended with the next numbers.
    """
    distinct = values.select(F.col(f"`{column}`").cast("string").alias("value")).filter("value is not null").distinct()
    placed = staged(distinct.withColumn("place", F.monotonically_increasing_id()), "numbers")
    counts = sorted(tuple(r) for r in placed.groupBy(F.shiftrightunsigned("place", 33).alias("part")).agg(F.count("*").alias("n")).collect())
    begins, upto = [], 0
    for part, n in counts:
        begins.append((part, upto))
        upto += n
    begin = values.sparkSession.createDataFrame(begins, "part long, begin long")
    met = placed.withColumn("part", F.shiftrightunsigned("place", 33)).join(begin, "part")
    return met.select("value", (F.col("begin") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("number"))


def numbered(df: DataFrame, dictionaries: Mapping[str, DataFrame], suffix: str = "_number") -> DataFrame:
    """The frame with the number of each column's value, null for a null; joined on a key that can be split."""
    for n, (column, dictionary) in enumerate(dictionaries.items()):
        key = f"_value{n}"
        named = dictionary.select(F.struct("value").alias(key), F.col("number").alias(f"{column}{suffix}"))
        df = df.withColumn(key, F.when(F.col(f"`{column}`").isNotNull(), F.struct(F.col(f"`{column}`").cast("string").alias("value")))).join(named, key, "left").drop(key)
    return df


def bitmaps(df: DataFrame, numbers: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """column, bucket and bitmap of the numbers that occur, for each group of `by`: partial results that can be merged.

    Rows become one small entry for each column and 32,768 numbers, aggregated where they are read; a hot value is one
    bit. The frame is read once, whatever the number of columns.
    """
    entry = lambda n, c: F.when(F.col(c).isNotNull(), F.struct(F.lit(n).alias("column"), F.bitmap_bucket_number(c).alias("bucket"), F.bitmap_bit_position(c).alias("bit")))
    entries = F.array_compact(F.array(*[entry(n, c) for n, c in enumerate(numbers)]))
    each = df.select(*by, F.inline(entries))
    return each.groupBy(*by, "column", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of several loads or finer groups as one for each group, column and bucket."""
    return maps.groupBy(*by, "column", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts_of(maps: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """unique_<name> of each group: the bits set in its bitmaps."""
    ones = F.bitmap_count("bits")
    wanted = [F.coalesce(F.sum(F.when(F.col("column") == n, ones)), F.lit(0)).cast("long").alias(f"unique_{name}") for n, name in enumerate(names)]
    return maps.groupBy(*by).agg(*wanted) if by else maps.agg(*wanted)


def distinct_counts(df: DataFrame, columns: Sequence[str], dictionaries: Mapping[str, DataFrame] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Exact distinct non-null values of several columns, in all or by group.

    Columns of whole numbers from 0 on that are dense already need no dictionary; others are numbered by theirs, which
    are made here if not given.
    """
    made = dict(dictionaries) if dictionaries is not None else {c: numbers_of(df, c) for c in columns}
    told = numbered(df.select(*dict.fromkeys([*by, *columns])), {c: made[c] for c in columns if c in made})
    number: list[Column | str] = [f"{c}_number" if c in made else c for c in columns]
    return counts_of(bitmaps(told, number, by), columns, by)
