"""One named query per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.text import (
    clean_prediction, ddl_statements, loose_match, normalize_sql, round_even,
)
from sqlyard.functions.templates import format_prompt
from sqlyard.operators import evaluation, prepare, profile, reports, result_sets, runs, sampling, scoring
from sqlyard.operators.row_scores import with_bleu
from sqlyard.plans import derived
from sqlyard.schemas import METRIC_LOG, RAW_EXAMPLES
from sqlyard.session import work_folder
from sqlyard.sources import tables
from sqlyard.streaming.plateau import keep_state_on_disk, plateau_stream

BASE, TUNED = derived.MODELS

Query = Callable[[SparkSession, str], DataFrame]


# ---- preparation ------------------------------------------------------------------------------

def prepare_examples(spark, sf):
    return sampling.train_test_split(prepare.prepare_examples(derived.examples(spark, sf)))


def prepare_instruct(spark, sf):
    return prepare.prepare_examples(derived.examples(spark, sf), "mistralai/Mistral-7B-Instruct-v0.3")


def text_only(spark, sf):
    return prepare.text_only(derived.examples(spark, sf))


def prompt_by_model(spark, sf):
    names = F.explode(F.array(*[F.lit(m) for m in derived.TEMPLATE_MODELS])).alias("model_name")
    rows = derived.examples(spark, sf).select("*", names)
    return rows.select(
        "ex_id", "model_name",
        format_prompt(F.col("model_name"), "question", "context").alias("prompt"),
        format_prompt(F.col("model_name"), "question", "context", "answer").alias("text"),
    )


def template_preview(spark, sf):
    return prepare.template_preview(derived.examples(spark, sf))


def preview_row(spark, sf):
    return prepare.preview_fields(sampling.first_rows(derived.examples(spark, sf), 1, "ex_id"))


def preview_prompt(spark, sf):
    prepared = prepare.prepare_examples(derived.examples(spark, sf))
    return prepare.preview_text(sampling.first_rows(prepared, 1, "ex_id"))


# ---- splits and samples -----------------------------------------------------------------------

def split_counts(spark, sf):
    parts = [
        sampling.train_test_split(df, key=key).select(F.lit(name).alias("source"), "split")
        for name, df, key in (
            ("examples", derived.examples(spark, sf).select("ex_id"), "ex_id"),
            ("documents", derived.table(spark, sf, "documents").select("doc_id"), "doc_id"),
        )
    ]
    return parts[0].unionByName(parts[1]).groupBy("source", "split").agg(F.count("*").alias("n_rows"))


def exact_split_counts(spark, sf):
    split = sampling.exact_split(derived.table(spark, sf, "documents").select("doc_id"), key="doc_id")
    return reports.split_counts(split)


def capped_split(spark, sf):
    split = sampling.train_test_split(derived.examples(spark, sf))
    return sampling.cap_splits(split, {"train": 2000, "test": 200}).select("ex_id", "split", "question")


def first_examples(spark, sf):
    return sampling.first_by_key(derived.examples(spark, sf), 500)


def first_many_examples(spark, sf):
    return sampling.first_by_key(derived.examples(spark, sf), 5000)


def random_sample_k(spark, sf):
    return sampling.random_sample(derived.table(spark, sf, "documents"), 5, "doc_id")


# ---- text -------------------------------------------------------------------------------------

def clean_predictions(spark, sf):
    return evaluation.clean_predictions(derived.predictions(spark, sf))


def clean_documents(spark, sf):
    docs = derived.table(spark, sf, "documents")
    return docs.select("doc_id", clean_prediction("text").alias("cleaned"))


def normalized_predictions(spark, sf):
    return derived.predictions(spark, sf).select("ex_id", "model", normalize_sql("raw_text").alias("norm"))


def normalized_documents(spark, sf):
    return derived.table(spark, sf, "documents").select("doc_id", normalize_sql("text").alias("norm"))


def ddl_statement_rows(spark, sf):
    """Statements of schemas made from the examples: the second holds a quoted ``;``, the third a trigger's body."""
    rows = derived.examples(spark, sf)
    second = F.concat(
        F.lit("\nCREATE TABLE notes (id INT, mark TEXT DEFAULT 'a;b', k INT DEFAULT "), F.col("ex_id").cast("string"),
        F.lit(");  ;\nCREATE TRIGGER t AFTER INSERT ON notes BEGIN UPDATE notes SET k = CASE WHEN k > 1 THEN 0 ELSE 1 END; DELETE FROM notes; END;\nDROP TABLE x"),
    )
    schema = F.concat("context", second)
    return rows.select("ex_id", F.posexplode(ddl_statements(schema)).alias("pos", "statement"))


def missing_tables(spark, sf):
    joined = evaluation.join_gold(
        evaluation.clean_predictions(derived.predictions(spark, sf)), derived.gold(spark, sf), "schema"
    )
    return evaluation.missing_table_rows(joined)


# ---- row scores -------------------------------------------------------------------------------

def _joined(spark, sf) -> DataFrame:
    cleaned = evaluation.clean_predictions(derived.predictions(spark, sf))
    return evaluation.join_gold(cleaned, derived.gold(spark, sf))


def exact_match(spark, sf):
    return _joined(spark, sf).select("ex_id", "model", evaluation.exact_match().alias("exact_match"))


def loose_matches(spark, sf):
    hit = loose_match("predicted_sql", "gold_sql")
    return _joined(spark, sf).select("ex_id", "model", hit.alias("loose_match"))


def bleu(spark, sf):
    scored = with_bleu(_joined(spark, sf), "pred_norm", "gold_norm")
    return scored.select("ex_id", "model", round_even("bleu", 6).alias("bleu"))


def bleu_text(spark, sf):
    scored = with_bleu(derived.long_pairs(spark, sf), "pred_norm", "gold_norm")
    return scored.select("doc_id", round_even("bleu", 6).alias("bleu"))


def _outcomes(spark, sf) -> DataFrame:
    pairs = derived.predictions(spark, sf).select("ex_id", "model")
    return result_sets.outcomes(pairs, derived.exec_rows(spark, sf), derived.exec_status(spark, sf))


def result_equality(spark, sf):
    return _outcomes(spark, sf).select("ex_id", "model", "result_equal")


def same_rows(spark, sf):
    """Lines of urgent orders, asked in two ways: by semi-join and by join."""
    # by hash of the few orders: a sort would hold all lines of a task
    orders = derived.table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").hint("shuffle_hash")
    lines = derived.table(spark, sf, "lineitem")
    wanted = ["l_orderkey", "l_linenumber", "l_quantity"]
    semi = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_semi").select(*wanted)
    inner = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(*wanted)
    return result_sets.same_rows(semi, inner)


# ---- evaluation -------------------------------------------------------------------------------

def _scored(spark, sf) -> DataFrame:
    return evaluation.score(derived.predictions(spark, sf), derived.gold(spark, sf), _outcomes(spark, sf))


def _classed(spark, sf) -> DataFrame:
    cleaned = evaluation.clean_predictions(derived.predictions(spark, sf))
    known = evaluation.with_run_errors(cleaned, derived.exec_status(spark, sf))
    return evaluation.classify_errors(evaluation.join_gold(known, derived.gold(spark, sf)))


def error_class(spark, sf):
    return _classed(spark, sf).select("ex_id", "model", "error_type")


def error_class_by_schema(spark, sf):
    cleaned = evaluation.clean_predictions(derived.predictions(spark, sf))
    joined = evaluation.join_gold(cleaned, derived.gold(spark, sf), "schema")
    return evaluation.classify_errors(evaluation.with_schema_errors(joined)).select("ex_id", "model", "error_type")


def error_class_forms(spark, sf):
    """Every error class, from captured errors and from the schema alone, over several schemas and shapes of query."""
    forms = derived.query_forms(spark, sf)
    examples = forms.select("ex_id", "schema", "gold_sql")
    joined = evaluation.join_gold(evaluation.clean_predictions(forms.select("ex_id", "model", "raw_text", "error")), examples, "schema")
    ran = evaluation.classify_errors(joined.withColumn("run_error", result_sets.error_kind("error"))).withColumnRenamed("error_type", "by_run")
    read = evaluation.classify_errors(evaluation.with_schema_errors(ran)).withColumnRenamed("error_type", "by_schema")
    both = tables.stored(read.select("ex_id", "by_run", "by_schema"), "forms")  # joined, cleaned and normalised once for both
    return both.select("ex_id", "by_run").join(both.select("ex_id", "by_schema"), "ex_id")


def error_distribution(spark, sf):
    return reports.error_distribution(_classed(spark, sf))


def error_share(spark, sf):
    return reports.error_share(reports.error_distribution(_classed(spark, sf)))


def result_records(spark, sf):
    return evaluation.result_records(_scored(spark, sf))


def eval_summary(spark, sf):
    return reports.eval_summary(_scored(spark, sf))


def comparison_records(spark, sf):
    return reports.comparison_records(_scored(spark, sf), BASE, TUNED)


def sample_predictions(spark, sf):
    """The first five examples that both models answered: chosen by key, then joined and cleaned."""
    answers = derived.predictions(spark, sf)
    both = answers.groupBy("ex_id").agg(F.count_distinct("model").alias("models")).where("models = 2").select("ex_id")
    first = F.broadcast(sampling.first_rows(both, 5, "ex_id"))  # five keys
    found = evaluation.score(answers.join(first, "ex_id", "left_semi"), derived.gold(spark, sf).join(first, "ex_id", "left_semi"))
    return reports.comparison_records(found, BASE, TUNED).select(
        "ex_id", "question", "gold_sql", "base_prediction", "finetuned_prediction"
    )


def summary_by_batches(spark, sf):
    """The summary of two batches of examples from their stored states."""
    def state(part: int) -> DataFrame:
        predictions = derived.predictions(spark, sf).where(F.col("ex_id") % 2 == part)
        return tables.stored(reports.summary_state(evaluation.score(predictions, derived.gold(spark, sf), _outcomes(spark, sf))), "state")

    return reports.summary_of_state(reports.merge_states(state(0), state(1))).drop("error_distribution")


def prediction_samples(spark, sf):
    return reports.prediction_samples(_scored(spark, sf))


def uneven_comparison(spark, sf):
    """Two models of which one left out every third example: compared over the examples that both answered."""
    scored = _scored(spark, sf).where((F.col("model") == BASE) | (F.col("ex_id") % 3 != 0))
    return reports.model_comparison(scored, BASE, TUNED)


def model_comparison(spark, sf):
    return reports.model_comparison(_scored(spark, sf), BASE, TUNED)


def metric_delta(spark, sf):
    return reports.metric_deltas(_scored(spark, sf), BASE, TUNED)


# ---- profile ----------------------------------------------------------------------------------

def length_profile(spark, sf):
    docs = derived.table(spark, sf, "documents")
    return profile.length_profile(profile.text_lengths(docs, {"text_len": "text"}))


def example_length_profile(spark, sf):
    lengths = {"q_len": "question", "sql_len": "answer", "schema_len": "context"}
    return profile.length_profile(profile.text_lengths(derived.examples(spark, sf), lengths))


def length_histogram(spark, sf):
    docs = derived.table(spark, sf, "documents")
    return profile.length_histogram(profile.text_lengths(docs, {"text_len": "text"}))


def example_length_histogram(spark, sf):
    lengths = {"q_len": "question", "sql_len": "answer", "schema_len": "context"}
    return profile.length_histogram(profile.text_lengths(derived.examples(spark, sf), lengths))


# ---- metric log -------------------------------------------------------------------------------

def plateau(spark, sf):
    return runs.plateau(derived.metric_log(spark, sf))


def best_checkpoint(spark, sf):
    return runs.best_checkpoint(derived.metric_log(spark, sf))


def retained_checkpoints(spark, sf):
    return runs.retained_checkpoints(derived.metric_log(spark, sf))


def run_summary(spark, sf):
    return runs.run_summary(derived.metric_log(spark, sf))


def run_history(spark, sf):
    best = runs.best_checkpoint(derived.metric_log(spark, sf))
    ordered = best.select(F.col("run_id").cast("long").alias("run_no"), "best_loss", "best_step")
    return runs.run_history(ordered, "run_no", ["best_loss"])


def plateau_stream_rows(spark, sf):
    """The events read as a stream to its end, in whatever order their files come; then each run's end is announced, and its steps
    have their turn. The rows the stream wrote are the result."""
    schema = derived.table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)  # bounds the rows of a batch
    events = source.parquet(_as_source(sf, "events"))
    log = events.select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("step"),
        F.col("value").alias("eval_loss"),
    ).to(METRIC_LOG)
    ends = f"{work_folder(spark, 'run-ends')}/ends"
    spark.createDataFrame([], METRIC_LOG).write.parquet(ends)
    both = log.unionByName(spark.readStream.schema(METRIC_LOG).parquet(ends))
    keep_state_on_disk(spark)
    walked, folder = plateau_stream(both, lag=None), work_folder(spark, "plateau")
    _run_stream(spark, walked, folder)
    runs_ = derived.metric_log(spark, sf).select("run_id", F.lit(None).cast("long").alias("step"), F.lit(None).cast("double").alias("eval_loss"))
    runs_.distinct().write.mode("append").parquet(ends)
    return _run_stream(spark, walked, folder).where("NOT late").drop("late")


def exact_match_stream(spark, sf):
    """Clean-up, normalising and exact match on a stream: the same column functions, no state."""
    schema = derived.table(spark, sf, "documents").schema
    docs = spark.readStream.schema(schema).parquet(_as_source(sf, "documents")).select("doc_id", "text").repartition("doc_id")  # few files feed few tasks
    matched = docs.select(
        "doc_id", (normalize_sql(clean_prediction("text")) == normalize_sql("text")).alias("exact_match")
    )
    return _run_stream(spark, matched, work_folder(spark, "exact-match"))


def _as_source(sf: str, name: str) -> str:
    """A table's path as a stream source takes it: a pattern that fits one file and a folder of part files alike."""
    return f"{sf}/{name}.parque[t]"


def _run_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """All that a stream has written to a folder, now that it has taken what there is; it goes on where it stopped."""
    query = (
        rows.writeStream.format("parquet").option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


# ---- scoring ----------------------------------------------------------------------------------

def request_status(spark, sf):
    status = scoring.request_status("question", "schema")
    return derived.requests(spark, sf).select("ex_id", status.alias("status"))


def answer_requests(spark, sf):
    return scoring.answer_requests(
        derived.requests(spark, sf), derived.TEMPLATE_MODELS[0], derived.FirstTablePredictor
    )


def score_batch(spark, sf):
    raw = scoring.score_batch(derived.gold(spark, sf), derived.TEMPLATE_MODELS[0], derived.FirstTablePredictor)
    return evaluation.clean_predictions(raw).drop("error")


def score_budget(spark, sf):
    """A predictor that gives too few answers, asked in batches of a few hundred characters: its rows say so, the others are answered."""
    raw = scoring.score_batch(derived.gold(spark, sf), derived.TEMPLATE_MODELS[0], derived.ForgetfulPredictor, budget=8192, most_rows=24)
    return evaluation.clean_predictions(raw)


def end_to_end(spark, sf):
    """Prepared, split, written; the test side's stored prompts answered, cleaned and scored; the summary of a stored report."""
    folder = work_folder(spark, "prepared")
    tables.write_splits(sampling.train_test_split(prepare.prepare_examples(derived.examples(spark, sf))), folder)
    held = tables.read_splits(spark, folder, "test")
    raw = tables.stored(scoring.score_batch(held, derived.TEMPLATE_MODELS[0], derived.CountingPredictor, "counting", prompt="prompt"), "answers")
    scored = tables.stored(evaluation.score(raw.drop("error"), held), "scored")
    report = work_folder(spark, "report")
    tables.write_report(evaluation.result_records(scored), reports.summary_with_errors(scored), report)
    results, summary = tables.read_report(spark, report)
    return summary.select("model", "num_samples", "exact_match_rate", "valid_sql_rate", "avg_bleu", F.explode("error_distribution").alias("error_type", "n"))


def score_models(spark, sf):
    models = {m: (m, derived.FirstTablePredictor) for m in derived.TEMPLATE_MODELS[:2]}
    return evaluation.clean_predictions(scoring.score_models(derived.gold(spark, sf), models)).drop("error")


# ---- files ------------------------------------------------------------------------------------

def jsonl_roundtrip(spark, sf):
    folder = work_folder(spark, "splits")
    tables.write_splits(sampling.train_test_split(prepare.prepare_examples(derived.examples(spark, sf))), folder)
    return tables.read_splits(spark, folder)


def jsonl_quarantine(spark, sf):
    """Lines of examples with broken ones among them: how many are read, rejected and kept aside, and the keys read."""
    k, folder = F.col("ex_id"), work_folder(spark, "lines")
    whole = F.to_json(F.struct("ex_id", "question", "context", "answer"))
    line = (F.when(k % 9 == 1, F.left(whole, F.length(whole) - 3)).when(k % 9 == 2, F.concat(F.lit("["), k, F.lit("]")))
            .when(k % 9 == 3, F.lit('{"ex_id": "many", "question": "?"}')).when(k % 9 == 4, "   ").otherwise(whole))
    derived.examples(spark, sf).select(line.alias("value")).write.text(f"{folder}/in")
    rows, rejected = tables.read_jsonl_checked(spark, f"{folder}/in", RAW_EXAMPLES)
    tables.quarantine(rejected, f"{folder}/aside")
    aside = spark.read.schema("path string, line string").json(f"{folder}/aside")
    good = rows.agg(F.lit("read").alias("kind"), F.count("*").alias("n"), F.sum("ex_id").alias("keys"))
    return good.union(aside.agg(F.lit("rejected"), F.count("*"), F.count_if(F.col("path").endswith(".txt"))))


def _stored_report(spark, sf):
    folder = work_folder(spark, "report")
    scored = tables.stored(_scored(spark, sf), "scored")
    tables.write_report(evaluation.result_records(scored), reports.summary_with_errors(scored), folder)
    return tables.read_report(spark, folder)


def report_readback(spark, sf):
    return tables.error_counts(_stored_report(spark, sf)[1])


def report_recount(spark, sf):
    return reports.recount_errors(_stored_report(spark, sf)[0], "model")


def _stored_comparison(spark, sf):
    folder = work_folder(spark, "comparison")
    scored = tables.stored(_scored(spark, sf), "scored")
    tables.write_report(
        reports.comparison_records(scored, BASE, TUNED), reports.model_comparison(scored, BASE, TUNED), folder
    )
    return tables.read_comparison(spark, folder)


def comparison_readback(spark, sf):
    return _stored_comparison(spark, sf)[0]


def _written_examples(spark, sf, kind: str) -> str:
    """Raw examples with null fields, written in one of the two formats that are read."""
    k = F.col("ex_id")
    rows = derived.examples(spark, sf).select(
        "ex_id", F.when(k % 5 != 0, F.col("question")).alias("question"), F.when(k % 7 != 0, F.col("context")).alias("context"),
        F.when(k % 11 != 0, F.col("answer")).alias("answer"))
    folder = f"{work_folder(spark, 'examples')}/examples.{kind}"
    rows.write.format(kind).save(folder)
    return folder


def read_examples_parquet(spark, sf):
    return tables.read_examples(spark, _written_examples(spark, sf, "parquet"))


def read_examples_json(spark, sf):
    return tables.read_examples(spark, _written_examples(spark, sf, "json"))


def prepare_null_fields(spark, sf):
    raw = tables.read_examples(spark, _written_examples(spark, sf, "parquet"))
    return prepare.prepare_examples(raw).select("ex_id", "prompt", "completion", "question", "schema", "gold_sql")


def row_at(spark, sf):
    return sampling.row_at(derived.examples(spark, sf), 7)


def missing_input(spark, sf):
    """The path that the error about an absent table names, beside the number of rows of one that is there."""
    there = tables.read_parquet(spark, f"{sf}/orders.parquet").agg(F.count("*").alias("n_rows"))
    try:
        tables.read_parquet(spark, f"{sf}/absent.parquet")
        said = ""
    except tables.MissingInputError as failure:
        said = str(failure)
    return there.select("n_rows", F.contains(F.lit(said), F.lit(f"{sf}/absent.parquet")).alias("names_path"))


def comparison_summary_readback(spark, sf):
    return _stored_comparison(spark, sf)[1]


def exact_match_own_keywords(spark, sf):
    """Exact match where the names of the two texts' column count as words without case."""
    cleaned = evaluation.clean_predictions(derived.predictions(spark, sf)).withColumn(
        "predicted_sql", F.regexp_replace("predicted_sql", "l_orderkey", "L_OrderKey"))
    joined = evaluation.join_gold(cleaned, derived.gold(spark, sf), keywords=[*fixed.KEYWORDS, "l_orderkey"])
    return joined.select("ex_id", "model", evaluation.exact_match().alias("exact_match"))


# ---- running query texts ----------------------------------------------------------------------

EXEC_PAIRS = [
    # gold, prediction
    ("SELECT l_returnflag, COUNT(*) FROM lineitem GROUP BY l_returnflag",
     "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag ORDER BY n"),
    ("SELECT o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority",
     "SELECT COUNT(*), o_orderpriority FROM orders GROUP BY o_orderpriority"),
    ("SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
     "SELECT n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')"),
    ("SELECT COUNT(*) FROM lineitem WHERE l_quantity > 25", "SELECT COUNT(*) FROM lineitem"),
    ("SELECT s_nationkey FROM supplier", "SELECT DISTINCT s_nationkey FROM supplier"),
    ("SELECT c_mktsegment, MAX(c_acctbal) FROM customer GROUP BY c_mktsegment",
     "SELECT c_mktsegment, MAX(c_acctbal) FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_mktsegment;"),
    ("SELECT COUNT(*) FROM orders", "SELECT COUNT(*) FROM orderz"),
    ("SELECT COUNT(*) FROM orders", "SELECT SUM(o_total) FROM orders"),
    ("SELECT COUNT(*) FROM orders", "SELECT MAX(CAST(o_orderpriority AS INT)) FROM orders"),
    ("SELECT COUNT(*) FROM orders", "SELECT COUNT(* FROM orders"),
    ("SELECT COUNT(*) FROM region", "WITH x AS (SELECT * FROM region) INSERT INTO region SELECT * FROM x"),
    ("SELECT COUNT(*) FROM region", "/* all of them */ SELECT COUNT(*) FROM region -- done"),
    ("SELECT COUNT(*) FROM nation", "(SELECT COUNT(*) FROM nation)"),
    ("SELECT r_name FROM region", "SELECT r_name FROM region WHERE r_name <> 'reflect('"),
    ("SELECT r_name FROM region", "SELECT r_name FROM region) x, (SELECT 1"),
]


def exec_pairs(spark, sf):
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]

    def register(own: SparkSession) -> None:
        for name in names:
            derived.table(own, sf, name).createOrReplaceTempView(name)

    texts = [
        (i, "model", side, text)
        for i, (gold, pred) in enumerate(EXEC_PAIRS) for side, text in (("gold", gold), ("pred", pred))
    ]
    return result_sets.captured_outcomes(*result_sets.capture_queries(spark, texts, register))


QUERIES: dict[str, Query] = {
    "prepare_examples": prepare_examples,
    "prepare_instruct": prepare_instruct,
    "text_only": text_only,
    "prompt_by_model": prompt_by_model,
    "template_preview": template_preview,
    "preview_row": preview_row,
    "preview_prompt": preview_prompt,
    "split_counts": split_counts,
    "exact_split_counts": exact_split_counts,
    "capped_split": capped_split,
    "first_examples": first_examples,
    "first_many_examples": first_many_examples,
    "random_sample_k": random_sample_k,
    "clean_predictions": clean_predictions,
    "clean_documents": clean_documents,
    "normalize_sql": normalized_predictions,
    "normalize_documents": normalized_documents,
    "ddl_statements": ddl_statement_rows,
    "missing_tables": missing_tables,
    "exact_match": exact_match,
    "loose_match": loose_matches,
    "bleu": bleu,
    "bleu_text": bleu_text,
    "result_equality": result_equality,
    "same_rows": same_rows,
    "error_class": error_class,
    "error_class_by_schema": error_class_by_schema,
    "error_class_forms": error_class_forms,
    "error_distribution": error_distribution,
    "error_share": error_share,
    "result_records": result_records,
    "eval_summary": eval_summary,
    "comparison_records": comparison_records,
    "sample_predictions": sample_predictions,
    "summary_by_batches": summary_by_batches,
    "prediction_samples": prediction_samples,
    "uneven_comparison": uneven_comparison,
    "model_comparison": model_comparison,
    "metric_delta": metric_delta,
    "length_profile": length_profile,
    "example_length_profile": example_length_profile,
    "length_histogram": length_histogram,
    "example_length_histogram": example_length_histogram,
    "plateau": plateau,
    "plateau_stream": plateau_stream_rows,
    "exact_match_stream": exact_match_stream,
    "best_checkpoint": best_checkpoint,
    "retained_checkpoints": retained_checkpoints,
    "run_summary": run_summary,
    "run_history": run_history,
    "request_status": request_status,
    "answer_requests": answer_requests,
    "score_batch": score_batch,
    "score_budget": score_budget,
    "end_to_end": end_to_end,
    "score_models": score_models,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_quarantine": jsonl_quarantine,
    "report_readback": report_readback,
    "report_recount": report_recount,
    "comparison_readback": comparison_readback,
    "exec_pairs": exec_pairs,
    "read_examples_parquet": read_examples_parquet,
    "read_examples_json": read_examples_json,
    "prepare_null_fields": prepare_null_fields,
    "row_at": row_at,
    "missing_input": missing_input,
    "comparison_summary_readback": comparison_summary_readback,
    "exact_match_own_keywords": exact_match_own_keywords,
}
