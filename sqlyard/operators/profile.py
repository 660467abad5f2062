"""Length profile and histogram. Both work on a table of distinct lengths, built in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.functions.text import round_even


def text_lengths(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Character lengths; ``columns`` maps a new name to a text column."""
    return rows.select(*[F.length(text).alias(name) for name, text in columns.items()])


def value_counts(lengths: DataFrame) -> DataFrame:
    """``(metric, value, n)`` of every column. Tasks count before the shuffle, so what moves is the
    number of distinct lengths, however many rows share one."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in lengths.columns]
    return (
        lengths.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
        .groupBy("metric", "value").agg(F.count("*").alias("n"))
    )


def length_profile(lengths: DataFrame, places: int | None = 0) -> DataFrame:
    """Per column: count, mean, sample deviation, minimum, quartiles (linear), maximum."""
    counts = value_counts(lengths)
    wide = F.col("value").cast("decimal(38,0)")
    total, n = F.sum(wide * F.col("n")).cast("double"), F.sum("n")
    squares = F.sum((F.col("value") * F.col("value")).cast("decimal(38,0)") * F.col("n")).cast("double")
    count = n.cast("double")
    spread = F.when(n > 1, F.sqrt((squares - total * total / count) / (count - 1)))
    stats = {
        "mean": total / count,
        "std": spread,
        "min": F.min("value").cast("double"),
        "p25": F.percentile("value", F.lit(0.25), F.col("n")),
        "p50": F.percentile("value", F.lit(0.5), F.col("n")),
        "p75": F.percentile("value", F.lit(0.75), F.col("n")),
        "max": F.max("value").cast("double"),
    }
    shown = {k: v if places is None else round_even(v, places) for k, v in stats.items()}
    return counts.groupBy("metric").agg(n.alias("count"), *[v.alias(k) for k, v in shown.items()])


def length_histogram(lengths: DataFrame, bins: int = 60) -> DataFrame:
    """Per column and non-empty bin: bin number, its edges and its row count.

    Equal-width bins between a column's smallest and largest value, the last one closed. A column
    with one value gets a range one wide around it. A value is placed by comparing it with the
    edges as doubles, so it falls where array libraries put it.
    """
    column = Window.partitionBy("metric")  # over distinct lengths only
    lo, hi = F.min("value").over(column).cast("double"), F.max("value").over(column).cast("double")
    ranged = (
        value_counts(lengths).withColumns({"_lo": lo, "_hi": hi})
        .select(
            "metric", F.col("value").cast("double").alias("value"), "n",
            F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
            F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
        )
        .withColumn("step", (F.col("hi") - F.col("lo")) / bins)
        .withColumn("bin", F.least(
            F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)
        ))
    )

    def edge(i):
        return i * F.col("step") + F.col("lo")

    b = F.col("bin")
    placed = ranged.withColumn("bin", b - F.when(F.col("value") < edge(b), 1).otherwise(0))
    placed = placed.withColumn(
        "bin", b + F.when((b < bins - 1) & (F.col("value") >= edge(b + 1)), 1).otherwise(0)
    )
    return placed.groupBy("metric", "bin").agg(
        F.min(edge(b)).alias("bin_from"),
        F.min(F.when(b == bins - 1, F.col("hi")).otherwise(edge(b + 1))).alias("bin_to"),
        F.sum("n").alias("n"),
    )
