"""Predictions against gold: joined, cleaned, scored and classed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.names import missing_columns
from sqlyard.functions.text import (
    clean_prediction, col, is_valid_sql, missing_tables, normalize_sql, round_even, text_or_empty,
)
from sqlyard.operators.result_sets import PRED, error_kind
from sqlyard.operators.row_scores import with_bleu


def clean_predictions(predictions: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Replace raw model output by ``predicted_sql``."""
    return predictions.withColumn("predicted_sql", clean_prediction(text_or_empty(raw))).drop(raw)


def join_gold(
    predictions: DataFrame, examples: DataFrame, *extra: str, keywords: list[str] | None = None
) -> DataFrame:
    """Cleaned predictions beside their example's gold text, both normalised, with ``keywords`` instead of the fixed list.

    Gold is normalised before the join: once per example, not once per model.
    """
    gold = examples.select("ex_id", "gold_sql", *extra).withColumn("gold_norm", normalize_sql("gold_sql", keywords))
    return (
        predictions.join(gold.hint("merge"), "ex_id")  # shuffled: the work on the texts behind it is shared among all tasks
        # equal texts are normalised once
        .withColumn("pred_norm", F.when(F.col("predicted_sql") == F.col("gold_sql"), F.col("gold_norm")).otherwise(normalize_sql("predicted_sql", keywords)))
    )


def exact_match() -> Column:
    return F.col("pred_norm") == F.col("gold_norm")


def missing_table_rows(joined: DataFrame) -> DataFrame:
    """One row per prediction and table it reads that the example's schema does not declare."""
    return joined.select("ex_id", "model", F.explode(missing_tables("predicted_sql", "schema")).alias("table_name"))


def error_type(
    predicted: Column | str, pred_norm: Column | str, gold_norm: Column | str, run_error: Column | str
) -> Column:
    """Error class of one prediction, the first that applies. ``run_error`` is null where it ran."""
    by_clause = F
    for clause, name in fixed.CLAUSE_CLASSES:
        has = [F.contains(col(c), F.lit(clause)) for c in (gold_norm, pred_norm)]
        by_clause = by_clause.when(has[0] & ~has[1], name)
    # named once, so that Spark computes a costly ``run_error`` here, only where it decides
    return F.when(~is_valid_sql(predicted), "syntax_error").otherwise(F.coalesce(col(run_error), by_clause.otherwise("logic_error")))


def with_run_errors(predictions: DataFrame, status: DataFrame) -> DataFrame:
    """Add ``run_error``: the class of a prediction's captured error, null where it ran."""
    failed = (
        status.where((F.col("side") == PRED) & ~F.col("ok"))
        .select("ex_id", "model", error_kind(F.coalesce("error", F.lit("unknown"))).alias("run_error"))
    )
    return predictions.join(failed, ["ex_id", "model"], "left")


def with_schema_errors(joined: DataFrame) -> DataFrame:
    """Without captured runs: a prediction is ``wrong_table`` when its schema lacks a table it reads, else
    ``wrong_column`` when it certainly lacks a column. What is not decidable from the texts is left open."""
    lacks_table = F.size(missing_tables("predicted_sql", "schema")) > 0
    lacks_column = F.size(missing_columns("predicted_sql", "schema")) > 0
    return joined.withColumn("run_error", F.when(lacks_table, "wrong_table").when(lacks_column, "wrong_column"))


def classify_errors(joined: DataFrame) -> DataFrame:
    """Turn ``run_error`` into ``error_type``: null for exact matches, a class for every other row.

    Rows that are right by execution but not by text are classed too, as the published counts are.
    """
    kind = error_type("predicted_sql", "pred_norm", "gold_norm", "run_error")
    return joined.withColumn("error_type", F.when(~exact_match(), kind)).drop("run_error")


def score(
    predictions: DataFrame, examples: DataFrame, outcomes: DataFrame | None = None, keywords: list[str] | None = None
) -> DataFrame:
    """Result records of raw predictions ``(ex_id, model, raw_text)``, any number of models at once.

    ``outcomes`` is ``(ex_id, model, result_equal, run_error)``; without it ``execution_accuracy`` is
    null and no run errors are known. It joins first, while rows are narrow; gold text comes last and
    is not shuffled again. ``bleu`` is unrounded; ``result_records`` rounds it.
    """
    cleaned = clean_predictions(predictions)
    if outcomes is not None:
        cleaned = cleaned.join(outcomes, ["ex_id", "model"], "left")
        # counted only where the text is valid
        executed = is_valid_sql("predicted_sql") & F.coalesce("result_equal", F.lit(False))
    else:
        cleaned = cleaned.withColumn("run_error", F.lit(None).cast("string"))
        executed = F.lit(None).cast("boolean")
    classed = classify_errors(join_gold(cleaned, examples, "question", keywords=keywords))
    return with_bleu(classed, "pred_norm", "gold_norm").select(
        "ex_id", "model", "question", "gold_sql", "predicted_sql",
        exact_match().alias("exact_match"),
        is_valid_sql("predicted_sql").alias("valid_sql"),
        "bleu",
        executed.alias("execution_accuracy"),
        "error_type",
    )


def result_records(scored: DataFrame) -> DataFrame:
    return scored.withColumn("bleu", round_even("bleu", 4))
