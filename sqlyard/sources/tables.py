"""Reading and writing example tables and reports."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sqlyard import schemas
from sqlyard.functions import fixed
from sqlyard.operators.reports import recount_errors
from sqlyard.session import work_folder


class MissingInputError(FileNotFoundError):
    """An input path that does not exist."""


def _load(path: str, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as failure:
        if (failure.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise MissingInputError(f"no data at {path}; write it first") from failure
        raise


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return _load(path, lambda: reader.parquet(path))


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _load(path, lambda: spark.read.schema(schema).json(path))


def read_jsonl_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of JSON lines: rows that fit the schema, and ``(path, line)`` of those that do not.

    A line that is no JSON object, or holds a value of another kind than its column's, is rejected whole instead of becoming a row of
    nulls. Blank lines are neither. Both sides read the files on their own, in one pass each; ``quarantine`` keeps the second.
    """
    checked = StructType([*schema.fields, StructField("_rejected", StringType())])
    lines = _load(path, lambda: spark.read.text(path)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rejected"}
    parsed = lines.where(F.btrim("line", F.lit(fixed.BLANKS)) != "").withColumn("row", F.from_json("line", checked, options))
    good = F.col("row").isNotNull() & F.col("row._rejected").isNull() & F.col("line").rlike(r"^\s*\{")
    return parsed.where(good).select(*[F.col(f"row.`{f.name}`") for f in schema.fields]), parsed.where(~good).select("path", "line")


def quarantine(rejected: DataFrame, folder: str) -> None:
    """Adds rejected lines to a folder, beside those of earlier reads."""
    rejected.write.mode("append").json(folder)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Raw examples from parquet or JSON lines, told apart by the path's ending."""
    if path.rstrip("/").endswith((".json", ".jsonl")):
        return read_jsonl(spark, path, schemas.RAW_EXAMPLES)
    return read_parquet(spark, path, schemas.RAW_EXAMPLES)


def write_splits(prepared: DataFrame, folder: str) -> None:
    """JSON lines, one folder per split; every task writes its own files."""
    prepared.write.partitionBy("split").mode("overwrite").json(folder)


def read_splits(spark: SparkSession, folder: str, split: str | None = None) -> DataFrame:
    """Prepared examples; naming a split reads that split's folder only."""
    rows = read_jsonl(spark, folder, schemas.PREPARED)
    return rows.where(F.col("split") == split) if split else rows


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from the shared work folder: computed once, whoever reads them, and safe
    from lost executors."""
    folder = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder wherever Spark can write, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    try:
        return sorted(r["version"] for r in read_jsonl(spark, f"{folder}/manifest", schemas.MANIFEST).collect())  # one row a write
    except MissingInputError:
        return []


def write_report(records: DataFrame, summary: DataFrame, folder: str, keep: int = 2) -> int:
    """Records as parquet and the summary as JSON, in a folder of their own below ``folder``; its version number is returned.

    The manifest is written last and readers go by it, so they see a report whole or not at all: while it is written, and after a
    write that failed between, they read the one before. The last ``keep`` reports stay. One writer at a time. Both tables
    usually come from one scored table; pass that through ``stored`` first.
    """
    spark = records.sparkSession
    before = _versions(spark, folder)
    version, place = (before[-1] if before else 0) + 1, uuid.uuid4().hex
    records.write.parquet(f"{folder}/version={version}-{place}/results")
    summary.write.json(f"{folder}/version={version}-{place}/summary")
    spark.createDataFrame([(version, place)], schemas.MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    listed = read_jsonl(spark, f"{folder}/manifest", schemas.MANIFEST)
    for r in listed.where(F.col("version") == version - keep).collect():
        remove(spark, f"{folder}/version={r['version']}-{r['place']}")
    return version


def _latest(spark: SparkSession, folder: str) -> str:
    """The folder of the last report whose writing ended."""
    rows = read_jsonl(spark, f"{folder}/manifest", schemas.MANIFEST)
    last = rows.orderBy(F.desc("version"), "place").first()
    if last is None:
        raise MissingInputError(f"no report at {folder}; write it first")
    return f"{folder}/version={last['version']}-{last['place']}"


def read_report(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(results, summary)`` of one report. Missing metrics count as zero; a summary without error counts gets them
    from the results."""
    place = _latest(spark, folder)
    results = read_parquet(spark, f"{place}/results", schemas.RESULTS)
    summary = read_jsonl(spark, f"{place}/summary", schemas.SUMMARY)
    recounted = recount_errors(results, "model").groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct("error_type", "n"))).alias("_recount")
    )
    metrics = ["num_samples", "exact_match_rate", "valid_sql_rate", "avg_bleu", "execution_accuracy_rate"]
    has_counts = F.coalesce(F.size("error_distribution"), F.lit(0)) > 0
    filled = summary.join(recounted, "model", "left").select(
        "model",
        *[F.coalesce(m, F.lit(0)).alias(m) for m in metrics],
        F.when(has_counts, F.col("error_distribution")).otherwise(F.col("_recount")).alias("error_distribution"),
    )
    return results, filled


def read_comparison(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(records, summary)`` of a stored two-model comparison."""
    place = _latest(spark, folder)
    return (
        read_parquet(spark, f"{place}/results", schemas.COMPARISON),
        read_jsonl(spark, f"{place}/summary", schemas.COMPARISON_SUMMARY),
    )


def error_counts(summary: DataFrame) -> DataFrame:
    """Long form of the summary's error map, most frequent first."""
    return (
        summary.select("model", F.explode("error_distribution").alias("error_type", "n"))
        .orderBy("model", F.desc("n"), "error_type")
    )
