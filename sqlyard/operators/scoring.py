"""Running a caller's predictor over a table of questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.templates import format_prompt
from sqlyard.functions.text import clean_prediction, strip, text_or_empty

Predictor = Callable[[list[str]], list[str]]
"""Turns a batch of prompts into as many raw outputs."""


DEFAULT_BUDGET = 65_536
DEFAULT_ROWS = 64


def batches_by_length(lengths: list[int], budget: int, most_rows: int) -> list[list[int]]:
    """Positions in batches of prompts of about one length: the longest times their number stays within ``budget``, or one alone."""
    out, batch = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        if batch and (len(batch) == most_rows or lengths[i] * (len(batch) + 1) > budget):
            out.append(batch)
            batch = []
        batch.append(i)
    return out + [batch] * bool(batch)


def ask(predictor: Predictor, prompts: list[str], budget: int = DEFAULT_BUDGET, most_rows: int = DEFAULT_ROWS) -> list[tuple[str | None, str | None]]:
    """``(answer, error)`` for each prompt, in place. A batch that fails, or comes back with another number of answers, is asked one
    by one, so an error stays with its prompt."""
    found: list[tuple[str | None, str | None]] = [(None, None)] * len(prompts)

    waiting = batches_by_length([len(p) for p in prompts], budget, most_rows)[::-1]
    while waiting:  # no function that calls itself: it would keep all texts until a full garbage collection
        places = waiting.pop()
        try:
            answers = list(predictor([prompts[i] for i in places]))
            wrong = None if len(answers) == len(places) else f"{len(answers)} answers to {len(places)} prompts"
        except Exception as failure:  # reported beside the prompt
            wrong = str(failure) or type(failure).__name__
        if wrong is None:
            for i, answer in zip(places, answers):
                found[i] = (answer, None)
        elif len(places) == 1:
            found[places[0]] = (None, wrong)
        else:
            waiting += [[i] for i in reversed(places)]
    return found


def prediction(prompt: Column, make_predictor: Callable[[], Predictor], budget: int = DEFAULT_BUDGET, most_rows: int = DEFAULT_ROWS) -> Column:
    """``struct<raw, error>`` for a prompt column, both null where the prompt is.

    ``make_predictor`` runs once per task, so a model loads once per task. Only the prompt travels to Python, in Arrow batches; the
    row's other columns stay in the JVM. Each Arrow batch is a window whose prompts are sorted by length and asked in batches of
    ``most_rows`` at most, whose longest prompt times their number is ``budget`` characters at most (a longer one goes alone).
    """
    @F.pandas_udf("raw string, error string")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = make_predictor()
        for prompts in batches:
            asked = prompts[prompts.notna()]
            out = pd.DataFrame({"raw": None, "error": None}, index=prompts.index, dtype="object")
            if len(asked):
                out.loc[asked.index, ["raw", "error"]] = ask(predictor, asked.tolist(), budget, most_rows)
            yield out

    return predict.asNondeterministic()(prompt)


def score_batch(
    examples: DataFrame, model_name: str, make_predictor: Callable[[], Predictor], label: str | None = None, prompt: str | None = None,
    budget: int = DEFAULT_BUDGET, most_rows: int = DEFAULT_ROWS,
) -> DataFrame:
    """``(ex_id, model, raw_text, error)``; ``error`` says why a row has no answer.

    Prompts are rendered from ``question`` and ``schema``, or taken as they are stored from the column named ``prompt``.
    """
    text = format_prompt(model_name, text_or_empty("question"), text_or_empty("schema")) if prompt is None else text_or_empty(prompt)
    asked = examples.select("ex_id", F.lit(label or model_name).alias("model"), prediction(text, make_predictor, budget, most_rows).alias("a"))
    return asked.select("ex_id", "model", F.col("a.raw").alias("raw_text"), F.col("a.error").alias("error"))


def score_models(
    examples: DataFrame, models: dict[str, tuple[str, Callable[[], Predictor]]], **settings
) -> DataFrame:
    """Several models over the same examples; ``models`` maps a label to (model name, factory), ``settings`` go to ``score_batch``."""
    parts = [score_batch(examples, name, make, label, **settings) for label, (name, make) in models.items()]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored


# ---- requests ---------------------------------------------------------------------------------

def request_status(question: Column | str, schema: Column | str) -> Column:
    """Warning for a request that cannot be answered, null for one that can; the question counts first."""
    return (
        F.when(strip(text_or_empty(question)) == "", fixed.STATUS_NO_QUESTION)
        .when(strip(text_or_empty(schema)) == "", fixed.STATUS_NO_SCHEMA)
    )


def answer_requests(
    requests: DataFrame, model_name: str, make_predictor: Callable[[], Predictor], budget: int = DEFAULT_BUDGET, most_rows: int = DEFAULT_ROWS,
) -> DataFrame:
    """Requests ``(ex_id, question, schema)`` to ``(ex_id, sql, status)``; bad requests reach no predictor, an error stays with its request."""
    warning = request_status("question", "schema")
    prompt = F.when(warning.isNull(), format_prompt(model_name, F.col("question"), F.col("schema")))
    answered = requests.select("ex_id", warning.alias("warning"), prediction(prompt, make_predictor, budget, most_rows).alias("a"))
    return answered.select(
        "ex_id",
        F.coalesce(clean_prediction("a.raw"), F.lit("")).alias("sql"),
        F.coalesce("warning", F.concat(F.lit(fixed.STATUS_ERROR_PREFIX), F.col("a.error")), F.lit(fixed.STATUS_OK)).alias("status"),
    )
