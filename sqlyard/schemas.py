"""Schemas of the stored tables. Every read names one; nothing is inferred."""

from pyspark.sql.types import (
    BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_S, _B, _D, _L = StringType(), BooleanType(), DoubleType(), LongType()

RAW_EXAMPLES = _table(ex_id=_L, question=_S, context=_S, answer=_S)

PREPARED = _table(
    ex_id=_L, text=_S, prompt=_S, completion=_S, question=_S, schema=_S, gold_sql=_S, split=_S,
)

RESULTS = _table(
    ex_id=_L, model=_S, question=_S, gold_sql=_S, predicted_sql=_S, exact_match=_B, valid_sql=_B,
    bleu=_D, execution_accuracy=_B, error_type=_S,
)

COMPARISON = _table(
    ex_id=_L, question=_S, gold_sql=_S, base_prediction=_S, finetuned_prediction=_S,
    base_exact_match=_B, finetuned_exact_match=_B, base_bleu=_D, finetuned_bleu=_D,
    base_exec_accuracy=_B, finetuned_exec_accuracy=_B,
)

COMPARISON_SUMMARY = _table(
    base_model=_S, finetuned_model=_S, num_samples=_L, base_exact_match=_D, finetuned_exact_match=_D,
    base_valid_sql_rate=_D, finetuned_valid_sql_rate=_D, base_avg_bleu=_D, finetuned_avg_bleu=_D,
    base_execution_accuracy=_D, finetuned_execution_accuracy=_D,
)

SUMMARY = _table(
    model=_S, num_samples=_L, exact_match_rate=_D, valid_sql_rate=_D, avg_bleu=_D,
    execution_accuracy_rate=_D, error_distribution=MapType(_S, _L),
)

SUMMARY_STATE = _table(
    model=_S, error_type=_S, n=_L, bleu_high=_L, bleu_low=_L, n_bleu=_L, exact_match=_L, valid_sql=_L, execution_accuracy=_L,
    exact_match_known=_L, valid_sql_known=_L, execution_accuracy_known=_L,
)

MANIFEST = _table(version=_L, place=_S)

METRIC_LOG = _table(run_id=_S, step=_L, eval_loss=_D)

CAPTURED_ROWS = _table(ex_id=_L, model=_S, side=_S, row_text=_S)
CAPTURED_STATUS = _table(ex_id=_L, model=_S, side=_S, ok=_B, error=_S)
