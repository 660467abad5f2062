"""From raw question/schema/SQL rows to prompt and completion rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.templates import format_prompt, get_formatter, render
from sqlyard.functions.text import col, text_or_empty, with_stop_mark


def prepare_examples(
    examples: DataFrame, model_name: Column | str = fixed.DEFAULT_MODEL,
    question: str = "question", context: str = "context", answer: str = "answer",
) -> DataFrame:
    """``(ex_id, question, context, answer)`` to ``(ex_id, text, prompt, completion, question, schema, gold_sql)``.

    Missing columns and nulls count as empty text. ``gold_sql`` keeps the answer as it came;
    ``completion`` and ``text`` end with the stop mark.
    """
    def field(name: str) -> Column:
        return text_or_empty(name) if name in examples.columns else F.lit("")

    q, schema, sql = field(question), field(context), field(answer)
    completion = with_stop_mark(sql)
    return examples.select(
        "ex_id",
        format_prompt(model_name, q, schema, completion).alias("text"),
        format_prompt(model_name, q, schema).alias("prompt"),
        completion.alias("completion"),
        q.alias("question"),
        schema.alias("schema"),
        sql.alias("gold_sql"),
    )


def text_only(examples: DataFrame, model_name: str = fixed.DEFAULT_MODEL) -> DataFrame:
    """One training text per example, the answer as it came (no stop mark)."""
    formatter = get_formatter(model_name)
    return examples.select(
        "ex_id",
        formatter(text_or_empty("question"), text_or_empty("context"), text_or_empty("answer")).alias("text"),
    )


def template_preview(examples: DataFrame) -> DataFrame:
    """Every template side by side: one row per example and template."""
    q, schema, sql = (text_or_empty(c) for c in ("question", "context", "answer"))
    shown = [
        F.struct(F.lit(name).alias("template"), render(name, q, schema, sql).alias("text"))
        for name in fixed.TEMPLATES
    ]
    return examples.select("ex_id", F.inline(F.array(*shown)))


def preview_fields(rows: DataFrame, width: int = 200) -> DataFrame:
    """Columns of each row as ``(field, value)``, values cut to ``width`` characters for display."""
    cells = [
        F.struct(F.lit(c).alias("field"), F.left(F.col(c).cast("string"), F.lit(width)).alias("value"))
        for c in rows.columns
    ]
    return rows.select(F.inline(F.array(*cells)))


def preview_text(rows: DataFrame, text: str = "text", width: int = 600) -> DataFrame:
    return rows.select(F.left(col(text), F.lit(width)).alias("preview"))
