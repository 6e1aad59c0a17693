"""Per-group statistics (G15): mean, median, min and max of numeric columns.

The median is exact without gathering a group. Spark's exact ``percentile``
keeps one counter per distinct value of a group in one task, which a group
holding a third of all rows cannot afford. Instead:

1. one aggregate gives, for all columns, count, mean, min, max and quantiles
   from ``percentile_approx``, a bounded sketch whose rank error is at most
   n / accuracy. For groups of fewer than ``accuracy`` values that is less than
   one rank: the two middle values are exact, and nothing else is needed;
2. larger groups (at most one in ``accuracy`` rows is one) take a bracket
   [lo, hi] around the middle ranks from the same sketch. One more pass counts
   their values below ``lo`` and pre-aggregates those inside the bracket to
   (value, count), at most about 8n / accuracy distinct values per group;
3. a running sum over those bracket values finds the middle rank(s); an even
   count averages the two middle values.

Without larger groups the second pass drops its rows before they move (and
callers that know the number of rows leave it out). The join of values and
brackets is one of two plain shuffles, so adaptive execution splits a hot
group; the joins before it only meet aggregated rows. Minima and
maxima keep the column type, groups without values keep a row. Means and
medians are rounded to ``digits`` so results do not depend on summation or
interpolation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievekit.functions.skew import null_safe_join

DEFAULT_ACCURACY = 100_000


def _long_form(df: DataFrame, group_cols: Sequence[str], columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    return (df.select(*group_cols, F.explode(cells).alias("__cell"))
            .select(*group_cols, F.col("__cell.name").alias("__name"), F.col("__cell.x").alias("__x"))
            .filter(F.col("__x").isNotNull()))


def _medians_long(vals: DataFrame, keys: list[str], summary: DataFrame) -> DataFrame:
    """Exact median per ``keys`` from long-form values and their bracket summary.

    Returns ``keys`` + summary columns + ``__median``. Values below the
    bracket collapse into one null-valued row per key; sorted first, it makes
    the running sums absolute ranks, so no separate count has to be joined
    back. Summary columns ride along as grouping keys (they are fixed per key).
    """
    carried = ["__n"]
    joined = null_safe_join(vals, summary, keys, "inner")  # two plain shuffles: adaptive execution splits a hot group
    inside = joined.filter(F.col("__x") <= F.col("__hi"))
    bucket = F.when(F.col("__x") < F.col("__lo"), F.lit(None).cast("double")).otherwise(F.col("__x"))
    counted = inside.groupBy(*keys, *carried, bucket.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    w = (Window.partitionBy(*keys).orderBy(F.col("__v").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("__end", F.sum("__c").over(w)).withColumn("__start", F.col("__end") - F.col("__c"))
    k1 = F.floor((F.col("__n") - 1) / 2)
    k2 = F.floor(F.col("__n") / 2)

    def at(k):
        hit = (k >= F.col("__start")) & (k < F.col("__end")) & F.col("__v").isNotNull()
        return F.max(F.when(hit, F.col("__v")))

    picked = ranked.groupBy(*keys, *carried).agg(at(k1).alias("__v1"), at(k2).alias("__v2"))
    missed = F.raise_error(F.lit("the bracket misses the middle rank: use a higher accuracy")).cast("double")
    middle = F.when(F.col("__v1").isNull() | F.col("__v2").isNull(), missed).otherwise((F.col("__v1") + F.col("__v2")) / 2)
    return picked.select(*keys, *carried, middle.alias("__median"))


def _quantiles(accuracy: int) -> list[float]:
    """Both middle ranks of up to ``accuracy`` values, and a bracket around those of more."""
    margin = 4.0 / accuracy
    return [0.5, 0.5 + 0.25 / accuracy, max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)]


def _facts(column: str, at: int, accuracy: int) -> list:
    x = F.col(f"`{column}`").cast("double")
    return [F.count(x).alias(f"__n{at}"), F.percentile_approx(x, _quantiles(accuracy), accuracy).alias(f"__q{at}")]


def _medians(df: DataFrame, facts: DataFrame, g: list[str], columns: Sequence[str], accuracy: int) -> DataFrame:
    """(group columns, __name, __median) of the groups with ``accuracy`` values or more."""
    cells = F.array(*[F.struct(F.lit(c).alias("__name"), F.col(f"__n{i}").alias("__n"), F.col(f"__q{i}")[2].alias("__lo"),
                               F.col(f"__q{i}")[3].alias("__hi")) for i, c in enumerate(columns)])
    large = facts.select(*[F.col(f"`{c}`") for c in g], F.explode(cells).alias("__cell")).select(
        *[F.col(f"`{c}`") for c in g], "__cell.*").filter(F.col("__n") >= accuracy)
    some = large.agg(F.count(F.lit(1)).alias("n")).scalar()  # without large groups nothing is shuffled
    return _medians_long(_long_form(df.filter(some > 0), g, columns), g + ["__name"], large)


def exact_median(df: DataFrame, group_cols: Sequence[str], column: str,
                 accuracy: int = DEFAULT_ACCURACY, alias: str | None = None) -> DataFrame:
    """Exact median of ``column`` per group (nulls ignored), skew-safe; groups without values are left out."""
    g = list(group_cols)
    facts = df.groupBy(*g).agg(*_facts(column, 0, accuracy))
    return _with_medians(df, facts, g, [column], accuracy, None).filter(F.col("__m0").isNotNull()).select(
        *g, F.col("__m0").alias(alias or f"{column}_median"))


def _with_medians(df: DataFrame, facts: DataFrame, g: list[str], columns: Sequence[str], accuracy: int, max_rows: int | None) -> DataFrame:
    """``facts`` with the median of column i as ``__m{i}``."""
    middle = {i: (F.col(f"__q{i}")[0] + F.col(f"__q{i}")[1]) / 2 for i in range(len(columns))}
    if max_rows is not None and max_rows < accuracy:
        return facts.withColumns({f"__m{i}": m for i, m in middle.items()})
    long = _medians(df, facts, g, columns, accuracy)
    wide = long.groupBy(*g).agg(*[F.max(F.when(F.col("__name") == c, F.col("__median"))).alias(f"__l{i}") for i, c in enumerate(columns)])
    both = null_safe_join(facts, wide, g, "left")
    return both.withColumns({f"__m{i}": F.when(F.col(f"__n{i}") < accuracy, m).otherwise(F.col(f"__l{i}")) for i, m in middle.items()})


def group_stats(df: DataFrame, group_cols: Sequence[str], columns: Sequence[str], digits: int = 6,
                accuracy: int = DEFAULT_ACCURACY, max_rows: int | None = None) -> DataFrame:
    """Mean, median, min and max per group for each column (min/max keep the
    column type). ``max_rows``: what the caller knows ``df`` not to exceed."""
    g = list(group_cols)
    # straight from the columns: a group without any value stays, and nothing passes through double
    facts = df.groupBy(*g).agg(*[a for i, c in enumerate(columns) for a in (
        F.round(F.avg(f"`{c}`"), digits).alias(f"{c}_mean"), F.min(f"`{c}`").alias(f"{c}_min"), F.max(f"`{c}`").alias(f"{c}_max"),
        *_facts(c, i, accuracy))])
    out = _with_medians(df, facts, g, columns, accuracy, max_rows)
    medians = {c: F.round(F.col(f"__m{i}"), digits).alias(f"{c}_median") for i, c in enumerate(columns)}
    return out.select(*g, *[x for c in columns for x in (f"{c}_mean", medians[c], f"{c}_min", f"{c}_max")])
