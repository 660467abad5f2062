"""Prompt templates as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.text import col, strip


def _fill(template: str, values: dict[str, Column]) -> Column:
    pieces = [p for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*[values[p[1:-1]] if p[1:-1] in values else F.lit(p) for p in pieces])


def render(
    template: str, question: Column | str, schema: Column | str, sql: Column | str | None = None
) -> Column:
    """Prompt of the named template; where ``sql`` is given and not null the answer follows."""
    prompt_text, answer_text = fixed.TEMPLATES[template]
    prompt = _fill(prompt_text, {"schema": strip(schema), "question": strip(question)})
    if sql is None:
        return prompt
    answer = _fill(answer_text, {"sql": strip(sql)})
    return F.concat(prompt, F.coalesce(answer, F.lit("")))


def format_generic(question, schema, sql=None) -> Column:
    return render("generic", question, schema, sql)


def format_mistral_instruct(question, schema, sql=None) -> Column:
    return render("mistral-instruct", question, schema, sql)


def format_llama3_chat(question, schema, sql=None) -> Column:
    return render("llama3-chat", question, schema, sql)


def format_chatml(question, schema, sql=None) -> Column:
    return render("chatml", question, schema, sql)


def template_for(model_name: str) -> str:
    """Template name for one model name, settled while the plan is built."""
    name = model_name.lower()
    fits = (t for t, rule in fixed.TEMPLATE_RULES if all(any(w in name for w in g) for g in rule))
    return next(fits, fixed.DEFAULT_TEMPLATE)


def template_column(model_name: Column | str) -> Column:
    """Template name for a column of model names."""
    name = F.lower(col(model_name))
    chosen = None
    for template, rule in fixed.TEMPLATE_RULES:
        fits = F.lit(True)
        for group in rule:
            any_word = F.lit(False)
            for word in group:
                any_word = any_word | F.contains(name, F.lit(word))
            fits = fits & any_word
        chosen = F.when(fits, template) if chosen is None else chosen.when(fits, template)
    return chosen.otherwise(fixed.DEFAULT_TEMPLATE)


def get_formatter(model_name: str):
    """Function ``(question, schema, sql=None) -> Column`` for a model name."""
    template = template_for(model_name)
    return lambda question, schema, sql=None: render(template, question, schema, sql)


def format_prompt(
    model_name: Column | str, question: Column | str, schema: Column | str,
    sql: Column | str | None = None,
) -> Column:
    """Prompt for a model. A string is one model's name; a Column holds a name per row."""
    if isinstance(model_name, str):
        return render(template_for(model_name), question, schema, sql)
    chosen = template_column(model_name)
    prompt = None
    for template in fixed.TEMPLATES:
        text = render(template, question, schema, sql)
        prompt = F.when(chosen == template, text) if prompt is None else prompt.when(chosen == template, text)
    return prompt
