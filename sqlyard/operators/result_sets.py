"""Comparing what two queries return."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.errors.exceptions.captured import convert_exception
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sqlyard.functions import fixed
from sqlyard.functions.text import col
from sqlyard.schemas import CAPTURED_STATUS
from sqlyard.session import work_folder

PRED, GOLD = "pred", "gold"


def _weighted(
    df: DataFrame, keys: tuple[str, ...], weight: Column, text: Column | None = None,
    is_pair: bool = False, error: Column | None = None,
) -> DataFrame:
    return df.select(
        *keys, (F.lit(None) if text is None else text).cast("string").alias("row_text"),
        weight.cast("int").alias("_weight"), F.lit(is_pair).alias("_pair"),
        (F.lit(None) if error is None else error).cast("int").alias("_error"),
    )


def _verdicts(weighted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Equal where every distinct row weighs zero in sum.

    The first sum spreads by key and text, so one key with very many rows is shared among tasks;
    the second takes one partial verdict per task and key. Every value summed up has a fixed width,
    so Spark aggregates by hash, without sorting.
    """
    return (
        weighted.groupBy(*keys, "row_text")
        .agg(F.sum("_weight").alias("_surplus"), F.bool_or("_pair").alias("_pair"), F.max("_error").alias("_error"))
        .groupBy(*keys)
        .agg(
            F.bool_and(F.col("_surplus") == 0).alias("result_equal"),
            F.bool_or("_pair").alias("_pair"), F.max("_error").alias("_error"),
        )
    )


def _captured(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    weight = F.when(F.col("side") == GOLD, -1).otherwise(1)
    return _weighted(rows, keys, weight, F.col("row_text"))


def result_equality(rows: DataFrame, keys: tuple[str, ...] = ("ex_id", "model")) -> DataFrame:
    """Per key: do both sides hold the same multiset of ``row_text``? Keys without rows do not appear."""
    return _verdicts(_captured(rows, keys), keys).select(*keys, "result_equal")


def outcomes(pairs: DataFrame, rows: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """``(ex_id, model, result_equal, run_error)`` for every pair.

    Two empty results are equal, an error on either side never is. ``run_error`` is the class of the
    prediction's own error, null where it ran. Pairs come in as rows of weight zero and errors as
    rows nothing can balance, so pairs without rows and failed runs need no join.
    """
    keys = ("ex_id", "model")
    parts = _captured(rows, keys).unionByName(_weighted(pairs, keys, F.lit(0), is_pair=True))
    if status is not None:
        failed = status.where(~F.col("ok"))
        code = F.when(F.col("side") == PRED, _error_code(F.coalesce("error", F.lit("unknown"))))
        parts = parts.unionByName(_weighted(failed, keys, F.lit(1), error=code))
    return _verdicts(parts, keys).where("_pair").select(*keys, "result_equal", _error_name("_error").alias("run_error"))


def _error_code(condition: Column | str) -> Column:
    """Place in ``fixed.RUN_ERRORS``, from 1, of Spark's error condition; null where nothing failed."""
    name = col(condition)
    code = F.when(name.isNull(), F.lit(None).cast("int"))
    for place, (start, _) in enumerate(fixed.RUN_ERRORS, 1):
        code = code.when(F.startswith(name, F.lit(start)), place)
    return code


def _error_name(code: Column | str) -> Column:
    name = F.lit(None).cast("string")
    for place, (_, kind) in enumerate(fixed.RUN_ERRORS, 1):
        name = F.when(col(code) == place, kind).otherwise(name)
    return name


def error_kind(condition: Column | str) -> Column:
    """Error class of a failed query from Spark's error condition; null where nothing failed."""
    return _error_name(_error_code(condition))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, one flag: are two DataFrames the same multiset of rendered rows?"""
    rendered = [
        df.select(F.lit(0).alias("_all"), F.lit(side).alias("side"), row_text(df).alias("row_text"))
        for df, side in ((left, PRED), (right, GOLD))
    ]
    verdict = result_equality(rendered[0].unionByName(rendered[1]), ("_all",))
    return verdict.agg(F.coalesce(F.bool_and("result_equal"), F.lit(True)).alias("result_equal"))


def row_text(df: DataFrame) -> Column:
    """A row as text by position: doubles at six places, null told apart from text, types from each other."""
    def cell(field) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            value = F.round(value, 6)
        text = F.regexp_replace(value.cast("string"), r"([\\|])", r"\\$1")
        if field.dataType.typeName() == "string":
            text = F.concat(F.lit("'"), text, F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    return F.concat_ws("|", *[cell(f) for f in df.schema.fields])


# ---- running query texts ----------------------------------------------------------------------

#: Plan nodes that do more than read.
_WRITES = re.compile("Command|Insert|Create|Drop|Delete|Merge|Update|Script")
#: Built-in functions that call a method of the JVM by name.
_REFUSED = {"reflect", "java_method", "try_reflect"}


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _calls(own: SparkSession, plan) -> tuple[set[str], set[str]]:
    """Kinds of all nodes of a parsed plan, in subqueries and WITH parts too, and the functions called anywhere, in lower case."""
    kinds, names, open_ = set(), set(), [plan]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        kinds.add(kind)
        if kind == "UnresolvedFunction":
            names.add(_items(node.nameParts())[-1].lower())
        elif kind == "UnresolvedTableValuedFunction":
            names.add(_items(node.name())[-1].lower())
        open_ += _items(node.children()) + _items(node.innerChildren())
        if is_instance_of(own._sc._gateway, node, "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"):
            open_ += _items(node.expressions())
    return kinds, names


def allowed_functions(own: SparkSession) -> set[str]:
    """Names of the session's built-in functions, without those that call methods by name."""
    found = {r[0].lower().rpartition(".")[2] for r in own.sql("SHOW SYSTEM FUNCTIONS").collect()}
    return found - _REFUSED


def _as_query(own: SparkSession, text: str, allowed: set[str]) -> DataFrame:
    """The text as a subquery, where the parser takes nothing that writes.

    The text must be a statement by itself too, so that no bracket in it closes the subquery. What the parser made of it decides:
    no node of the plan may write or run anything, and every function called must be one of ``allowed``.
    """
    parser = own._jsparkSession.sessionState().sqlParser()
    parser.parsePlan(text)
    wrapped = f"SELECT * FROM (\n{text}\n)"
    kinds, names = _calls(own, parser.parsePlan(wrapped))
    if any(_WRITES.search(k) for k in kinds) or names - allowed:
        raise AnalysisException("only queries of built-in functions run", errorClass="REFUSED")
    return own.sql(wrapped)


def capture_queries(
    spark: SparkSession, queries: Iterable[tuple[int, str, str, str]],
    register: Callable[[SparkSession], None], folder: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run query texts, read-only; return ``(rows, uses, status)``.

    ``queries`` yields ``(ex_id, model, side, text)``. Equal texts run once, and ``rows`` ``(text_no, row_text)`` holds their
    rows once; ``uses`` ``(ex_id, model, side, text_no)`` says who asked for which. Each distinct text is one Spark job
    started from here, so this is for a bounded list of hundreds; result rows go from the tasks to ``folder``
    and never through the driver. Texts run in a session of their own, in which ``register`` creates the views
    they may read. A text that is no plain query does not run and counts as failed.
    """
    folder = folder or work_folder(spark, "captured")
    numbers: dict[str, int] = {}
    uses = []
    for ex_id, model, side, text in queries:
        text = text.strip().rstrip(";").strip()
        uses.append((ex_id, model, side, numbers.setdefault(text, len(numbers))))

    own = spark.newSession()
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    register(own)
    allowed = allowed_functions(own)
    errors = {number: _store_result(own, text, allowed, number, f"{folder}/text={number}") for text, number in numbers.items()}
    status = spark.createDataFrame([(e, m, s, errors[n] is None, errors[n]) for e, m, s, n in uses], CAPTURED_STATUS)
    stored = [f"{folder}/text={number}" for number, error in errors.items() if error is None]
    schema = "text_no long, row_text string"
    rows = spark.read.schema(schema).parquet(*stored) if stored else spark.createDataFrame([], schema)
    return rows, spark.createDataFrame(uses, "ex_id long, model string, side string, text_no long"), status


def _store_result(own: SparkSession, text: str, allowed: set[str], number: int, path: str) -> str | None:
    """Write a text's rows; return the error condition, or None when all went well."""
    try:
        result = _as_query(own, text, allowed)
        # column names may repeat in a result; rows are compared by position
        result = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
        result.select(F.lit(number).cast("long").alias("text_no"), row_text(result).alias("row_text")).write.mode("overwrite").parquet(path)
    except (PySparkException, Py4JJavaError) as failure:
        found = failure if isinstance(failure, PySparkException) else convert_exception(failure.java_exception)
        return found.getCondition() or type(found).__name__
    return None


def captured_outcomes(rows: DataFrame, uses: DataFrame, status: DataFrame) -> DataFrame:
    """``(ex_id, model, result_equal, run_error)`` from captured texts; each distinct pair of texts is compared once."""
    keys, text_of = ("gold_no", "pred_no"), {s: F.max(F.when(F.col("side") == s, F.col("text_no"))) for s in (GOLD, PRED)}
    asked = uses.groupBy("ex_id", "model").agg(text_of[GOLD].alias("gold_no"), text_of[PRED].alias("pred_no"))
    pairs = asked.select(*keys).distinct()
    parts = _weighted(pairs, keys, F.lit(0), is_pair=True)
    for no, weight in (("gold_no", -1), ("pred_no", 1)):
        parts = parts.unionByName(_weighted(
            pairs.join(rows.withColumnRenamed("text_no", no), no), keys, F.lit(weight), F.col("row_text")))
    equal = _verdicts(parts, keys).select(*keys, "result_equal")
    code = F.max(F.when(F.col("side") == PRED, _error_code(F.when(~F.col("ok"), F.coalesce("error", F.lit("unknown"))))))
    ran = status.groupBy("ex_id", "model").agg(F.bool_and("ok").alias("_ok"), code.alias("_error"))
    return asked.join(equal, list(keys), "left").join(ran, ["ex_id", "model"]).select(
        "ex_id", "model", (F.col("_ok") & F.coalesce("result_equal", F.lit(True))).alias("result_equal"),
        _error_name("_error").alias("run_error"))
