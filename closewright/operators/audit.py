"""Join audits and table probes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closewright.functions.text import null_if_nan
from closewright.operators.distinct import distinct_counts
from closewright.operators.evidence import row_digest
from closewright.operators.joins import beside, stack_frames
from closewright.operators.naming import is_numeric, require_columns
from closewright.operators.reports import Report


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    """Rows per key; the map side combines, so a hot key is one partial row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_counts(df, keys).filter("rows > 1")


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once; a null key counts as a key.

    Counting and semi-joining, not a window: no task has to hold all rows of a hot key.
    """
    repeated = duplicate_keys(df, keys).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(repeated, same, "left_semi")


def _side_totals(counts: DataFrame, side: str) -> DataFrame:
    dup = F.col("rows") > 1
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(
        total(F.col("rows")).alias(f"{side}_total_rows"),
        total(F.when(dup, F.col("rows"))).alias(f"{side}_duplicates"),
        F.count_if(dup).alias(f"{side}_unique_dup_keys"),
    )


def merge_audit(left: DataFrame, right: DataFrame, on: Sequence[str], name: str = "merge") -> DataFrame:
    """One row: totals, duplicated rows and duplicated keys of both sides and the explosion warning."""
    require_columns(left, on, "left side")
    require_columns(right, on, "right side")
    both = beside(_side_totals(key_counts(left, on), "left"), _side_totals(key_counts(right, on), "right"))
    l_dup, r_dup = F.col("left_duplicates") > 0, F.col("right_duplicates") > 0
    return both.withColumns({"merge_name": F.lit(name), "has_duplicates": l_dup | r_dup, "explosion_risk": l_dup & r_dup})


def merge_key_overlap(left: DataFrame, right: DataFrame, on: Sequence[str], name: str = "merge") -> DataFrame:
    """One row: distinct, duplicate and null keys per side, matches, match rates and the inner-join size.

    One full join of per-key counts answers all of it. Keys are compared as the reference sets
    compare them, null equal to null; a joined key set with a null part never matches rows in SQL,
    so `joined_rows` counts only keys without nulls.
    """
    require_columns(left, on, "left side")
    require_columns(right, on, "right side")
    renamed = key_counts(right, on, "r").withColumnsRenamed({k: f"_{k}" for k in on})
    same = F.lit(True)
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = key_counts(left, on, "l").join(renamed, same, "full")
    in_left, in_right = F.col("l").isNotNull(), F.col("r").isNotNull()
    null_left, null_right = F.lit(False), F.lit(False)
    for k in on:
        null_left, null_right = null_left | F.col(k).isNull(), null_right | F.col(f"_{k}").isNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    counts = joined.agg(
        total(F.col("l")).alias("left_rows"), total(F.col("r")).alias("right_rows"),
        F.count_if(in_left).alias("left_unique_keys"), F.count_if(in_right).alias("right_unique_keys"),
        total(F.when(null_left, F.col("l"))).alias("left_null_keys"), total(F.when(null_right, F.col("r"))).alias("right_null_keys"),
        F.count_if(in_left & in_right).alias("matching_keys"), F.count_if(in_left & ~in_right).alias("left_only_keys"),
        F.count_if(~in_left & in_right).alias("right_only_keys"),
        F.coalesce(F.sum(F.when(in_left & in_right & ~null_left, F.col("l").cast("decimal(19,0)") * F.col("r"))), F.lit(0)).cast("decimal(38,0)").alias("joined_rows"),
    )
    rate = lambda side: F.round(F.try_divide(F.col("matching_keys") * 100, F.col(f"{side}_unique_keys")), 2)
    return counts.withColumns({
        "merge_name": F.lit(name),
        "left_duplicate_keys": F.col("left_rows") - F.col("left_unique_keys"),
        "right_duplicate_keys": F.col("right_rows") - F.col("right_unique_keys"),
        "left_match_rate": rate("left"), "right_match_rate": rate("right"),
    })


def key_sets(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every distinct key with the side it occurs on: both, left_only or right_only."""
    l = left.select(*on).distinct().withColumn("_l", F.lit(1))
    r = right.select(*[F.col(k).alias(f"_{k}") for k in on]).distinct().withColumn("_r", F.lit(1))
    same = F.lit(True)
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return l.join(r, same, "full").select(*[F.coalesce(k, f"_{k}").alias(k) for k in on], side.alias("side"))


def probe_metrics(df: DataFrame, checkpoint: str, metrics: Sequence[str] = ()) -> DataFrame:
    """Long table of (checkpoint, metric, value): rows and columns, then Σ / mean / non-null of numeric
    columns and distinct / non-null of others, from one aggregate."""
    parts = {"row_count": F.count("*").cast("double"), "column_count": F.lit(float(len(df.columns)))}
    for c in metrics:
        if c not in df.columns:
            continue
        value = null_if_nan(c, df.schema[c].dataType)
        parts[f"{c}_non_null_count"] = F.count(value).cast("double")
        if is_numeric(df, c):
            parts[f"{c}_sum"] = F.coalesce(F.sum(value).cast("double"), F.lit(0.0))
            parts[f"{c}_mean"] = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
        else:
            parts[f"{c}_unique_count"] = F.count_distinct(value).cast("double")
    return unpivot_metrics(df.agg(*[v.alias(k) for k, v in parts.items()]), list(parts)).select(
        F.lit(checkpoint).alias("checkpoint"), "metric", "value"
    )


def unpivot_metrics(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names])
    return one_row.select(F.inline(entries))


def table_probe(
    df: DataFrame, name: str, amount_col: str | None = None, date_col: str | None = None, key_cols: Sequence[str] = (), dictionaries: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row: rows, columns, nulls, duplicated rows, amount sum, date range and distinct keys.

    Rows are grouped by their SHA-256, so the shuffle moves digests and the probed columns, not
    whole rows. All rows of a group are equal; what does not count distinct values is summed on
    the way, so the table is read once. Several distinct counts copy each row once per key; with
    `dictionaries` (dense numbers of the keys' values) they are bitmaps of the numbers instead.
    """
    if dictionaries:
        told = table_probe(df, name, amount_col, date_col)
        return beside(told, distinct_counts(df, [k for k in key_cols if k in df.columns], dictionaries))
    present = lambda c: null_if_nan(F.col(f"`{c}`"), df.schema[c].dataType)
    nulls = sum((present(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    keys = [k for k in key_cols if k in df.columns]
    probed = df.select(
        F.unhex(row_digest(df)).alias("_digest"), nulls.alias("_nulls"), *[F.col(k).alias(f"_k_{k}") for k in keys],
        *([present(amount_col).alias("_amount")] if amount_col in df.columns else []),
        *([F.col(date_col).alias("_date")] if date_col in df.columns else []),
    )
    partial = [F.count("*").alias("_n"), F.sum("_nulls").alias("_nulls")]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    facts = [
        total("_n").alias("rows"), F.lit(len(df.columns)).cast("long").alias("cols"), total("_nulls").alias("nulls_total"),
        (total("_n") - F.count("*")).alias("duplicated_rows"),
    ]
    if amount_col in df.columns:
        partial.append(F.sum("_amount").alias("_amount"))
        facts.append(F.sum("_amount").alias("amount_sum"))
    if date_col in df.columns:
        partial += [F.min("_date").alias("_lo"), F.max("_date").alias("_hi")]
        facts += [F.date_format(F.min("_lo"), "yyyy-MM-dd").alias("min_date"), F.date_format(F.max("_hi"), "yyyy-MM-dd").alias("max_date")]
    facts += [F.count_distinct(f"_k_{k}").alias(f"unique_{k}") for k in keys]
    # Equal rows have equal keys, so grouping by the keys too changes nothing and spares a sort.
    return probed.groupBy("_digest", *[f"_k_{k}" for k in keys]).agg(*partial).agg(*facts).withColumn("name", F.lit(name))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
_BRACKET, _ACCURACY = 0.0005, 20_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], wanted: dict[str, float] = QUARTILES) -> DataFrame:
    """One row per column of exact, linearly interpolated quantiles; null where a column has no value.

    The ranks of all columns are bracketed by approximate percentiles, whose rank error (1 / accuracy) is smaller
    than the bracket, twice in a row: two passes of percentiles and two of counts, however many columns. About a
    millionth of the rows is then ranked, one row per value, by column and quantile.
    """
    value = {c: null_if_nan(c, df.schema[c].dataType).cast("double") for c in columns}
    sought = [(c, name, p) for c in columns for name, p in wanted.items()]
    n = df.agg(*[F.count(value[c]).alias(f"n{k}") for k, c in enumerate(columns)]).first()
    counts = {c: n[f"n{k}"] for k, c in enumerate(columns)}
    place = {}
    for c, name, p in sought:
        position = (counts[c] - 1) * p
        place[c, name] = (position, int(position), -int(-position // 1))
    inside = {(c, name): F.lit(True) for c, name, _ in sought}
    below, total = {key: 0 for key in inside}, {key: counts[key[0]] for key in inside}
    held = [key for key in inside if counts[key[0]]]
    if not held:
        return df.sparkSession.createDataFrame([(c, *[None] * len(wanted)) for c in columns], "column string, " + ", ".join(f"{name} double" for name in wanted))
    for _ in range(2):
        points = []
        for key in held:
            _, first, last = place[key]
            share = [max(0.0, (first - below[key]) / total[key] - _BRACKET), min(1.0, (last + 1 - below[key]) / total[key] + _BRACKET)]
            points.append(F.percentile_approx(F.when(inside[key], value[key[0]]), share, _ACCURACY))
        ends = dict(zip(held, df.agg(*points).first(), strict=True))
        inside = {key: value[key[0]].between(*ends[key]) for key in held}
        got = df.agg(*[F.count_if(value[key[0]] < ends[key][0]) for key in held], *[F.count_if(inside[key]) for key in held]).first()
        below, total = dict(zip(held, got[: len(held)], strict=True)), dict(zip(held, got[len(held) :], strict=True))
    facts = F.array(*[F.when(inside[key], F.struct(F.lit(key[0]).alias("column"), F.lit(key[1]).alias("name"), value[key[0]].alias("v"))) for key in held])
    kept = df.select(F.explode(F.array_compact(facts)).alias("x")).groupBy("x.column", "x.name", "x.v").agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.partitionBy("column", "name").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.create_map(*[F.lit(x) for key in held for x in (f"{key[0]}\0{key[1]}", below[key])])
    ranked = kept.withColumn("upto", running + known[F.concat("column", F.lit("\0"), "name")])
    picked = []
    for name in wanted:
        parts = []
        for c in columns:
            if counts[c]:
                position, first, last = place[c, name]
                here = (F.col("column") == c) & (F.col("name") == name)
                low, high = (F.min(F.when(here & (F.col("upto") > at), F.col("v"))) for at in (first, last))
                parts.append((low + (high - low) * (position - first)).alias(f"{c}\0{name}"))
        picked += parts
    one = ranked.agg(*picked)
    rows = [F.struct(F.lit(c).alias("column"), *[(F.col(f"`{c}\0{name}`") if counts[c] else F.lit(None).cast("double")).alias(name) for name in wanted]) for c in columns]
    return one.select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, one row per column."""
    value = {c: null_if_nan(c, df.schema[c].dataType).cast("double") for c in columns}
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[fn(value[c]).alias(f"{name}{k}") for k, c in enumerate(columns) for name, fn in moments.items()])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{k}").alias(name) for name in moments]) for k, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows))).join(exact_quantiles(df, columns), "column")


def table_summary(df: DataFrame, name: str) -> DataFrame:
    """One row per column: table, rows, column and type."""
    return summary_report(df, name).of(df)


def summary_report(df: DataFrame, name: str) -> Report:
    """The rows of `table_summary`, to be gathered by an aggregate or a write."""
    types = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype")) for c, t in df.dtypes])
    return Report((F.count("*").alias("rows"),), lambda one: one.select(F.lit(name).alias("table"), "rows", F.inline(types)))
