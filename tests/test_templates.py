import pytest
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.templates import (
    format_chatml, format_generic, format_llama3_chat, format_mistral_instruct, format_prompt,
    get_formatter, template_column, template_for,
)
from sqlyard.operators import prepare

QUESTION = "Which lake is the deepest?"
SCHEMA = "CREATE TABLE lakes (lake TEXT, depth REAL, frozen INT);"
SQL = "SELECT lake FROM lakes ORDER BY depth DESC LIMIT 1;"

MARKS = [
    ("some-DELPHI-model", "chatml", "<|im_start|>"),
    ("acme/qwen-small", "chatml", "<|im_start|>"),
    ("Instruct-your-own-MISTRAL", "mistral-instruct", "[INST]"),
    ("acme/mistral-plain", "generic", "### Task:"),
    ("chat-llama-3-tiny", "llama3-chat", "<|begin_of_text|>"),
    ("llama-3-Instruct", "llama3-chat", "<|begin_of_text|>"),
    ("acme/llama-3", "generic", "### Task:"),
    ("acme/own-coder", "generic", "### Task:"),
]


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([(f" {QUESTION}\n", f"\u3000{SCHEMA} ", f" {SQL} ")], "q string, s string, a string")


def text(df, column):
    return df.select(column.alias("t")).first()["t"]


def test_generic(one):
    prompt = (
        "### Task: Generate a single SQL query to answer the following question.\n"
        "Do not repeat any conditions or output multiple queries.\n\n"
        f"### Database Schema:\n{SCHEMA}\n\n### Question:\n{QUESTION}\n\n### SQL Query:\n"
    )
    assert text(one, format_generic("q", "s")) == prompt
    assert text(one, format_generic("q", "s", "a")) == prompt + SQL


def test_mistral(one):
    prompt = f"<s>[INST] {fixed.SYSTEM_TEXT}\n\n### Database Schema:\n{SCHEMA}\n\n### Question:\n{QUESTION} [/INST]"
    assert text(one, format_mistral_instruct("q", "s")) == prompt
    assert text(one, format_mistral_instruct("q", "s", "a")) == prompt + f" {SQL}</s>"


def test_llama3(one):
    prompt = (
        f"<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{fixed.SYSTEM_TEXT}<|eot_id|>"
        f"<|start_header_id|>user<|end_header_id|>\n\n### Database Schema:\n{SCHEMA}\n\n"
        f"### Question:\n{QUESTION}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
    )
    assert text(one, format_llama3_chat("q", "s")) == prompt
    assert text(one, format_llama3_chat("q", "s", "a")) == prompt + SQL + "<|eot_id|>"


def test_chatml(one):
    prompt = (
        f"<|im_start|>system\n{fixed.SYSTEM_TEXT}<|im_end|>\n<|im_start|>user\n"
        f"### Database Schema:\n{SCHEMA}\n\n### Question:\n{QUESTION}<|im_end|>\n<|im_start|>assistant\n"
    )
    assert text(one, format_chatml("q", "s")) == prompt
    assert text(one, format_chatml("q", "s", "a")) == prompt + SQL + "<|im_end|>"


def test_null_answer_leaves_the_prompt(one):
    no_sql = F.lit(None).cast("string")
    assert text(one, format_chatml("q", "s", no_sql)) == text(one, format_chatml("q", "s"))


@pytest.mark.parametrize("model,template,mark", MARKS)
def test_dispatch_by_name(one, model, template, mark):
    assert template_for(model) == template
    assert mark in text(one, get_formatter(model)("q", "s", "a"))
    assert mark in text(one, format_prompt(model, "q", "s", "a"))


def test_dispatch_by_column(spark):
    names = spark.createDataFrame([(m, t, k) for m, t, k in MARKS], "model string, template string, mark string")
    rows = names.select(
        "template", "mark", template_column("model").alias("got"),
        format_prompt(F.col("model"), F.lit(QUESTION), F.lit(SCHEMA), F.lit(SQL)).alias("text"),
    ).collect()
    assert all(r["got"] == r["template"] and r["mark"] in r["text"] for r in rows)


def test_prepare_keeps_gold_and_fills_missing(spark):
    raw = spark.createDataFrame(
        [(1, " q ", "s", " SELECT 1;; "), (2, None, "s", None)], "ex_id long, question string, context string, answer string"
    )
    rows = {r["ex_id"]: r for r in prepare.prepare_examples(raw).collect()}
    assert rows[1]["gold_sql"] == " SELECT 1;; " and rows[1]["completion"] == "SELECT 1;"
    assert rows[1]["text"] == rows[1]["prompt"] + "SELECT 1;"
    assert rows[1]["question"] == " q " and rows[1]["schema"] == "s"
    assert rows[2]["question"] == "" and rows[2]["gold_sql"] == "" and rows[2]["completion"] == ";"
    lacking = prepare.prepare_examples(raw.drop("context")).collect()
    assert all(r["schema"] == "" for r in lacking)


def test_previews(spark):
    raw = spark.createDataFrame([(1, "q" * 300, "s", "a")], "ex_id long, question string, context string, answer string")
    fields = {r["field"]: r["value"] for r in prepare.preview_fields(raw).collect()}
    assert fields == {"ex_id": "1", "question": "q" * 200, "context": "s", "answer": "a"}
    assert {r["template"] for r in prepare.template_preview(raw).collect()} == set(fixed.TEMPLATES)
    whole = prepare.prepare_examples(raw)
    assert prepare.preview_text(whole, width=50).first()["preview"] == whole.first()["text"][:50]
    assert prepare.text_only(raw).first()["text"].endswith("### SQL Query:\na")
