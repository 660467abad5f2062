"""Summaries of scored predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.functions.text import col, round_even

METRICS = ["exact_match", "valid_sql", "bleu", "execution_accuracy"]


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("n_rows"))


def _share(flag: str) -> Column:
    """Percentage of true among all rows; null without a single known value."""
    known = F.count(flag) > 0
    hits = F.count_if(F.col(flag))
    return F.when(known, hits / F.count("*") * 100)


def _bleu_units() -> tuple[Column, Column]:
    """A score between 0 and 1 in whole units of 2**-52, as a high and a low part: sums of them are exact, in whatever order, for
    2**36 rows."""
    units = F.rint(F.col("bleu") * float(2 ** 52)).cast("long")
    return F.shiftright(units, 26), units.bitwiseAND((1 << 26) - 1)


def _mean_bleu(high: Column, low: Column, known: Column) -> Column:
    return F.when(known > 0, (high.cast("double") / known * float(2 ** 26) + low.cast("double") / known) / float(2 ** 52))


def _means() -> dict[str, Column]:
    return {
        "exact_match": _share("exact_match"),
        "valid_sql": _share("valid_sql"),
        "bleu": _mean_bleu(*[F.sum(c) for c in _bleu_units()], F.count("bleu")),
        "execution_accuracy": _share("execution_accuracy"),
    }


def eval_summary(scored: DataFrame) -> DataFrame:
    """One row per model: sample count, three rates in percent (2 places), mean BLEU (4 places)."""
    m = _means()
    return scored.groupBy("model").agg(
        F.count("*").alias("num_samples"),
        round_even(m["exact_match"], 2).alias("exact_match_rate"),
        round_even(m["valid_sql"], 2).alias("valid_sql_rate"),
        round_even(m["bleu"], 4).alias("avg_bleu"),
        round_even(m["execution_accuracy"], 2).alias("execution_accuracy_rate"),
    )


def error_distribution(scored: DataFrame) -> DataFrame:
    """Rows per model and error class; exact matches have no class. ``error_rank`` runs from the most frequent."""
    counts = (
        scored.where(F.col("error_type").isNotNull())
        .groupBy("model", "error_type").agg(F.count("*").alias("n"))
    )
    # at most a dozen classes per model
    order = Window.partitionBy("model").orderBy(F.desc("n"), "error_type")
    return counts.withColumn("error_rank", F.row_number().over(order))


def error_share(distribution: DataFrame) -> DataFrame:
    """Each class's share of its model's errors, in percent."""
    total = F.sum("n").over(Window.partitionBy("model"))
    return distribution.select("model", "error_type", "n", round_even(F.col("n") / total * 100, 2).alias("share_pct"))


_FLAGS = ("exact_match", "valid_sql", "execution_accuracy")
_SUMS = ["n", "bleu_high", "bleu_low", "n_bleu", *_FLAGS, *[f"{f}_known" for f in _FLAGS]]


def summary_state(scored: DataFrame) -> DataFrame:
    """What a summary needs of scored rows, per model and error class: counts and exact sums, a dozen rows per model.

    States of several batches are stored and joined by ``merge_states`` without a second look at the rows, and joined states are the
    state of all rows, bit by bit.
    """
    high, low = _bleu_units()
    return scored.groupBy("model", "error_type").agg(
        F.count("*").alias("n"), F.sum(high).alias("bleu_high"), F.sum(low).alias("bleu_low"), F.count("bleu").alias("n_bleu"),
        *[F.count_if(F.col(f)).alias(f) for f in _FLAGS], *[F.count(f).alias(f"{f}_known") for f in _FLAGS])


def merge_states(*states: DataFrame) -> DataFrame:
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    return both.groupBy("model", "error_type").agg(*[F.sum(c).alias(c) for c in _SUMS])


def summary_of_state(state: DataFrame) -> DataFrame:
    """``eval_summary`` plus the error counts as a map, written most frequent first."""
    def rate(flag: str) -> Column:
        share = F.sum(flag) / F.sum("n") * 100
        return round_even(F.when(F.sum(f"{flag}_known") > 0, share), 2).alias(f"{flag}_rate")

    classes = F.filter(F.collect_list(F.struct(
        (-F.col("n")).alias("order"), F.coalesce("error_type", F.lit("")).alias("kind"), "n"
    )), lambda c: c["kind"] != "")
    return state.groupBy("model").agg(
        F.sum("n").alias("num_samples"),
        rate("exact_match"), rate("valid_sql"),
        round_even(_mean_bleu(F.sum("bleu_high"), F.sum("bleu_low"), F.sum("n_bleu")), 4).alias("avg_bleu"),
        rate("execution_accuracy"),
        F.map_from_entries(F.transform(
            F.sort_array(classes), lambda c: F.struct(c["kind"].alias("key"), c["n"].alias("value"))
        )).alias("error_distribution"),
    )


def summary_with_errors(scored: DataFrame) -> DataFrame:
    """``eval_summary`` plus the error counts as a map, in one pass over the rows."""
    return summary_of_state(summary_state(scored))


def same_examples(scored: DataFrame, base: str, tuned: str) -> DataFrame:
    """``(ex_id, model, metrics)`` of two models, for the examples that both answered; one row per example and model."""
    sides = (("base", base), ("tuned", tuned))
    wide = scored.where(F.col("model").isin(base, tuned)).groupBy("ex_id").agg(
        *[F.count_if(F.col("model") == m).alias(f"_{side}") for side, m in sides],
        *[F.max(F.when(F.col("model") == m, F.col(c))).alias(f"_{side}_{c}") for side, m in sides for c in METRICS])
    rows = [F.struct(F.lit(m).alias("model"), *[F.col(f"_{side}_{c}").alias(c) for c in METRICS]) for side, m in sides]
    return wide.where("_base > 0 AND _tuned > 0").select("ex_id", F.inline(F.array(*rows)))


def prediction_samples(scored: DataFrame, most_chars: int = 220) -> DataFrame:
    """What a report shows of each row: the start of the prediction, the verdict, the score and the error class."""
    verdict = F.when(F.col("exact_match"), "exact").when(F.col("execution_accuracy"), "same result").otherwise("wrong")
    return scored.select(
        "ex_id", "model", F.left("question", F.lit(most_chars)).alias("question"), F.left("predicted_sql", F.lit(most_chars)).alias("prediction"),
        verdict.alias("verdict"), round_even("bleu", 4).alias("bleu"), F.coalesce("error_type", F.lit("")).alias("error_type"))


def comparison_records(scored: DataFrame, base: str, tuned: str) -> DataFrame:
    """Both models' answers to an example in one row."""
    sides = (("base", base), ("finetuned", tuned))

    def of(name: str, value: Column) -> Column:
        # first() over one row per example and model
        return F.first(F.when(F.col("model") == name, value), ignorenulls=True)

    return (
        scored.where(F.col("model").isin(base, tuned)).groupBy("ex_id").agg(
            F.first("question").alias("question"),
            F.first("gold_sql").alias("gold_sql"),
            *[of(m, F.col("predicted_sql")).alias(f"{side}_prediction") for side, m in sides],
            *[of(m, F.col("exact_match")).alias(f"{side}_exact_match") for side, m in sides],
            *[of(m, round_even("bleu", 4)).alias(f"{side}_bleu") for side, m in sides],
            *[of(m, F.col("execution_accuracy")).alias(f"{side}_exec_accuracy") for side, m in sides],
        )
        .where(F.col("base_prediction").isNotNull() & F.col("finetuned_prediction").isNotNull())
    )


def model_comparison(scored: DataFrame, base: str, tuned: str) -> DataFrame:
    """One row: the four metrics of two models side by side, over the examples that both answered."""
    s = eval_summary(same_examples(scored, base, tuned))

    def of(model: str, value: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(value)))

    sides = (("base", base), ("finetuned", tuned))
    return s.agg(
        F.lit(base).alias("base_model"), F.lit(tuned).alias("finetuned_model"),
        F.max("num_samples").alias("num_samples"),
        *[of(m, "exact_match_rate").alias(f"{side}_exact_match") for side, m in sides],
        *[of(m, "valid_sql_rate").alias(f"{side}_valid_sql_rate") for side, m in sides],
        *[of(m, "avg_bleu").alias(f"{side}_avg_bleu") for side, m in sides],
        *[of(m, "execution_accuracy_rate").alias(f"{side}_execution_accuracy") for side, m in sides],
    )


def metric_deltas(scored: DataFrame, base: str, tuned: str) -> DataFrame:
    """One row per metric: both values in percent, their difference, and both as shown (one place, signed), over the examples
    that both models answered."""
    means = same_examples(scored, base, tuned).groupBy("model").agg(
        *[(v * 100 if k == "bleu" else v).alias(k) for k, v in _means().items()]
    )
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    wide = means.select("model", F.inline(F.array(*cells))).groupBy("metric").agg(
        F.max(F.when(F.col("model") == base, F.col("value"))).alias("base_value"),
        F.max(F.when(F.col("model") == tuned, F.col("value"))).alias("tuned_value"),
    )
    # nine places hide the last bits of the two divisions, + 0.0 drops a minus zero
    delta = round_even(F.col("tuned_value") - F.col("base_value"), 9) + 0.0
    shown = round_even(delta, 1)
    return wide.select(
        "metric",
        round_even("base_value", 1).alias("base_value"),
        round_even("tuned_value", 1).alias("tuned_value"),
        shown.alias("delta"),
        F.concat(F.when(delta >= 0, "+").otherwise(""), F.format_string("%.1f", shown), F.lit("%")).alias("delta_text"),
    )


def recount_errors(results: DataFrame, *keys: str) -> DataFrame:
    """Error counts from stored result records; a record without a class counts as ``unknown``."""
    kind = F.coalesce("error_type", F.lit("unknown")).alias("error_type")
    return results.groupBy(*[col(k) for k in keys], kind).agg(F.count("*").alias("n"))
