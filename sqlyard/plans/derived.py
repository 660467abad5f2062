"""Example, prediction and log tables derived from the test tables, row for row.

The test tables hold no text-to-SQL data. Each function is a projection of one table, so its
size and the work on it grow with that table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlyard.functions.text import normalize_sql

MODELS = ["base", "tuned"]  # their position is also the shift of their prediction form

TEMPLATE_MODELS = [
    "mistralai/Mistral-7B-v0.3",
    "mistralai/Mistral-7B-Instruct-v0.3",
    "meta-llama/Llama-3.1-8B-Instruct",
    "Qwen/Qwen2-7B-Instruct",
    "microsoft/Phi-3-mini-128k-instruct",
    "codellama/CodeLlama-7b-hf",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw examples ``(ex_id, question, context, answer)``, one per order."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("ex_id"),
        _text(" How many lines has order ", k, "? ").alias("question"),
        F.lit("CREATE TABLE lineitem (l_orderkey INT, l_linenumber INT, l_quantity REAL);").alias("context"),
        _text(
            "SELECT COUNT(*) FROM lineitem WHERE l_orderkey = ", k, F.when(k % 3 == 0, ";").otherwise("")
        ).alias("answer"),
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples under the names evaluation uses: ``(ex_id, question, schema, gold_sql)``."""
    return examples(spark, sf_dir).select(
        "ex_id", "question", F.col("context").alias("schema"), F.col("answer").alias("gold_sql")
    )


def _with_models(df: DataFrame) -> DataFrame:
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("shift")) for i, m in enumerate(MODELS)])
    return df.select("ex_id", F.inline(models)).withColumn("form", (F.col("ex_id") + F.col("shift")) % 8)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw predictions ``(ex_id, model, raw_text)``, two per order, in eight forms."""
    k = F.col("ex_id")
    where = _text(" WHERE l_orderkey = ", k)
    right = _text("SELECT COUNT(*) FROM lineitem", where)
    forms = [
        _text(right, ";"),
        _text("```sql\nselect COUNT(*)  from lineitem  where l_orderkey = ", k, ";\n```"),
        _text(right, " AND l_orderkey = ", k),
        F.lit("SELECT COUNT(*) FROM lineitem"),
        _text("SELECT COUNT(*) FROM lineitems", where),
        _text("SELECT COUNT(*) FROM lineitem WHERE qty = ", k),
        F.lit("  "),
        _text("SELECT SUM(l_quantity) FROM lineitem", where, " ### Question: next"),
    ]
    raw = F.when(F.col("form") == 0, forms[0])
    for i, form in enumerate(forms[1:], 1):
        raw = raw.when(F.col("form") == i, form)
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ex_id"))
    return _with_models(keys).select("ex_id", "model", raw.alias("raw_text"))


def exec_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes ``(ex_id, model, side, ok, error)``: predictions of forms 4 and 5 failed."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ex_id"))
    error = (
        F.when(F.col("form") == 4, "TABLE_OR_VIEW_NOT_FOUND")
        .when(F.col("form") == 5, "UNRESOLVED_COLUMN.WITH_SUGGESTION")
    )
    sides = F.array(
        F.struct(F.lit("gold").alias("side"), F.lit(None).cast("string").alias("error")),
        F.struct(F.lit("pred").alias("side"), error.alias("error")),
    )
    return _with_models(keys).select("ex_id", "model", F.inline(sides)).select(
        "ex_id", "model", "side", F.col("error").isNull().alias("ok"), "error"
    )


def exec_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured rows ``(ex_id, model, side, row_text)`` from the lines of each order.

    ``base`` returns what gold returns. ``tuned`` misses line 1 where the key divides by 3 and
    repeats every row where it divides by 5.
    """
    k = F.col("l_orderkey")

    def made(model: str, side: str) -> Column:
        return F.struct(F.lit(model).alias("model"), F.lit(side).alias("side"))

    copies = (
        F.when((k % 3 == 0) & (F.col("l_linenumber") == 1), 0).when(k % 5 == 0, 2).otherwise(1)
    )
    return table(spark, sf_dir, "lineitem").select(
        k.alias("ex_id"), F.col("l_linenumber").cast("string").alias("row_text"),
        F.inline(F.concat(
            F.array(made("base", "gold"), made("base", "pred"), made("tuned", "gold")),
            F.array_repeat(made("tuned", "pred"), copies),
        )),
    ).select("ex_id", "model", "side", "row_text")


_ORDERS = "CREATE TABLE orders (o_orderkey INT, o_custkey INT, o_orderdate DATE, o_totalprice REAL, o_orderstatus TEXT);"
_CUSTOMERS = "CREATE TABLE customer (c_custkey INT PRIMARY KEY, c_name TEXT, \"c segment\" TEXT);\n" + _ORDERS

# (schema, gold, prediction, error of a captured run); {k} is the order's key
QUERY_FORMS = [
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "select o_totalprice from orders where o_orderkey = {k};", None),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "  ", "PARSE_EMPTY_STATEMENT"),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "SELECT o_totalprice FROM order_list WHERE o_orderkey = {k}", "TABLE_OR_VIEW_NOT_FOUND"),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "SELECT price FROM orders WHERE o_orderkey = {k}", "UNRESOLVED_COLUMN.WITH_SUGGESTION"),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "SELECT o_totalprice FROM orders WHERE o_key BETWEEN {k} AND {k}", "UNRESOLVED_COLUMN"),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "SELECT o_totalprice / 0 FROM orders WHERE o_orderkey = {k}", "DIVIDE_BY_ZERO"),
    (_ORDERS, "SELECT o_totalprice FROM orders WHERE o_orderkey = {k}", "SELECT o_totalprice FROM orders", None),
    (_CUSTOMERS, "SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderkey = {k}",
     "SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey = {k})", None),
    (_CUSTOMERS, "SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderkey = {k}",
     "SELECT c.c_name FROM customer AS c JOIN orders o ON c.c_custkey = o.c_custkey WHERE o.o_orderkey = {k}", "UNRESOLVED_COLUMN"),
    (_CUSTOMERS, "SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderkey = {k}",
     "SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE \"c segment\" = \"BUILDING\" AND rowid = {k}", None),
    (_ORDERS, "SELECT o_orderstatus, COUNT(*) FROM orders WHERE o_orderkey > {k} GROUP BY o_orderstatus",
     "SELECT o_orderstatus FROM orders WHERE o_orderkey > {k}", None),
    (_ORDERS, "SELECT o_orderkey FROM orders WHERE o_orderkey > {k} ORDER BY o_orderdate", "SELECT o_orderkey FROM orders WHERE o_orderkey > {k}", None),
    (_ORDERS, "SELECT o_orderkey FROM orders WHERE o_orderkey > {k} ORDER BY o_orderdate",
     "SELECT o_orderkey FROM orders WHERE o_orderkey > {k} ORDER BY order_date", "UNRESOLVED_COLUMN"),
    (_ORDERS, "SELECT o_orderkey FROM orders WHERE o_orderdate > '1995-01-01' AND o_orderkey <> {k}",
     "```sql\nSELECT o_orderkey FROM orders WHERE o_orderdate > DATE '1995-01-01' AND o_orderkey <> {k}\n```", None),
    (_ORDERS, "SELECT MAX(o_totalprice) FROM orders WHERE o_orderkey < {k}",
     "WITH t AS (SELECT o_totalprice AS p FROM orders WHERE o_orderkey < {k}) SELECT MAX(p) FROM t WHERE p > 0", None),
    (_ORDERS, "SELECT MAX(o_totalprice) FROM orders WHERE o_orderkey < {k}",
     "SELECT MAX(p) FROM (SELECT total AS p FROM orders WHERE o_orderkey < {k}) t", "UNRESOLVED_COLUMN"),
]


def query_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ex_id, model, question, schema, gold_sql, raw_text, error)``: every order with one of the forms above, by its key."""
    k, form = F.col("o_orderkey"), (F.col("o_orderkey") % len(QUERY_FORMS)).cast("int")

    def part(i: int) -> Column:
        return F.replace(F.get(F.array(*[F.lit(f[i]).cast("string") for f in QUERY_FORMS]), form), F.lit("{k}"), k.cast("string"))

    return table(spark, sf_dir, "orders").select(
        k.alias("ex_id"), F.lit("forms").alias("model"), F.lit("?").alias("question"), part(0).alias("schema"), part(1).alias("gold_sql"),
        part(2).alias("raw_text"), part(3).alias("error"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, step, eval_loss)``: a run per user, steps numbered as events are, in order of time."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("step"),
        F.col("value").alias("eval_loss"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ex_id, question, schema)`` with blank questions and schemas among them."""
    return gold(spark, sf_dir).select(
        "ex_id",
        F.when(F.col("ex_id") % 7 == 0, " ").otherwise(F.col("question")).alias("question"),
        F.when(F.col("ex_id") % 11 == 0, "\n").otherwise(F.col("schema")).alias("schema"),
    )


def long_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document beside one benchmark text, whole and normalised: ``(doc_id, pred_norm, gold_norm)``.

    Items are dealt out by document key and normalised before the join, once each. The join is
    an equality of item keys; Spark broadcasts the benchmark only while its size is below the
    session's limit. Items are the numbers from 0 on, so an item's key is its place.
    """
    items = table(spark, sf_dir, "benchmark")
    size = items.agg(F.count("*")).scalar()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("doc_id") % size).alias("place"), normalize_sql("text").alias("pred_norm")
    )
    gold_texts = items.select(F.col("item_id").alias("place"), normalize_sql("text").alias("gold_norm"))
    return docs.join(gold_texts, "place").select("doc_id", "pred_norm", "gold_norm")


class FirstTablePredictor:
    """Stand-in for a model: counts the rows of the first table the prompt's schema names, fenced."""

    def __call__(self, prompts: list[str]) -> list[str]:
        return [f"```sql\nSELECT COUNT(*) FROM {self._first_table(p)};\n```" for p in prompts]

    @staticmethod
    def _first_table(prompt: str) -> str:
        return prompt.split("CREATE TABLE ", 1)[-1].split(" ", 1)[0]


class CountingPredictor:
    """Stand-in for a model that reads the order's number off the prompt: right for even ones, without the condition for odd ones."""

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.answer(int(re.findall(r"has order (\d+)", p)[-1])) for p in prompts]

    def answer(self, k: int) -> str:
        return f"SELECT COUNT(*) FROM lineitem{f' WHERE l_orderkey = {k}' if k % 2 == 0 else ''};"


class ForgetfulPredictor(CountingPredictor):
    """The same, but it gives no answer for orders that end in 7: too few answers to a batch with one of them."""

    def __call__(self, prompts: list[str]) -> list[str]:
        numbers = [int(re.findall(r"has order (\d+)", p)[-1]) for p in prompts]
        return [self.answer(k) for k in numbers if k % 10 != 7]
