import pytest
from pyspark.sql import functions as F

from sqlyard import schemas
from sqlyard.functions import fixed
from sqlyard.operators import evaluation, prepare, sampling, scoring
from sqlyard.plans import derived
from sqlyard.session import work_folder
from sqlyard.sources import tables


def examples(spark, n=20):
    return spark.range(n).select(
        F.col("id").alias("ex_id"), F.concat(F.lit("q \"é\"\n"), F.col("id").cast("string")).alias("question"),
        F.lit("CREATE TABLE t (a INT);").alias("context"), F.lit("SELECT a FROM t").alias("answer"),
    )


def test_splits_round_trip(spark, tmp_path):
    prepared = sampling.train_test_split(prepare.prepare_examples(examples(spark)), 0.3)
    folder = str(tmp_path / "new" / "splits")
    tables.write_splits(prepared, folder)
    back = tables.read_splits(spark, folder)
    assert sorted(back.select(prepared.columns).collect()) == sorted(prepared.collect())
    train = tables.read_splits(spark, folder, "train")
    assert train.count() == prepared.where("split = 'train'").count()
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    one = tables.read_jsonl(spark, f"{folder}/split=test", schemas.PREPARED)
    assert one.count() == prepared.where("split = 'test'").count()


def test_read_examples_by_ending(spark, tmp_path):
    examples(spark).write.json(str(tmp_path / "raw.jsonl"))
    examples(spark).write.parquet(str(tmp_path / "raw.parquet"))
    want = sorted(examples(spark).collect())
    for name in ("raw.jsonl", "raw.parquet"):
        assert sorted(tables.read_examples(spark, str(tmp_path / name)).collect()) == want


def test_missing_input_is_named(spark, tmp_path):
    for read in (lambda p: tables.read_splits(spark, p), lambda p: tables.read_parquet(spark, p)):
        with pytest.raises(tables.MissingInputError, match="nowhere"):
            read(str(tmp_path / "nowhere"))


def test_report_readback_fills_gaps(spark, tmp_path):
    folder = str(tmp_path / "report")
    results = spark.createDataFrame(
        [(1, "m", None, None, None, True, True, 1.0, None, None), (2, "m", None, None, None, False, True, 0.1, None, "logic_error"),
         (3, "m", None, None, None, False, True, 0.1, None, "logic_error")], schemas.RESULTS
    )
    summary = spark.createDataFrame([("m", 3, 33.33, None, None, None, {}), ("k", 1, 1.0, 1.0, 1.0, 1.0, {"x": 1})], schemas.SUMMARY)
    tables.write_report(results, summary, folder)
    back_results, back = tables.read_report(spark, folder)
    assert back_results.count() == 3
    rows = {r["model"]: r for r in back.collect()}
    assert rows["m"]["valid_sql_rate"] == 0 and rows["m"]["error_distribution"] == {"unknown": 1, "logic_error": 2}
    assert rows["k"]["error_distribution"] == {"x": 1}
    assert [(r["error_type"], r["n"]) for r in tables.error_counts(back).where("model = 'm'").collect()] == [("logic_error", 2), ("unknown", 1)]


class NoSetting:
    """As much of a session as ``work_folder`` looks at, without a checkpoint setting."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return default


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second
    assert work_folder(NoSetting("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(NoSetting("spark://host:7077"), "x")


def test_score_batch(spark):
    rows = spark.createDataFrame(
        [(1, "q", "CREATE TABLE cats (a INT);"), (2, "q", "CREATE TABLE dogs (a INT);")], "ex_id long, question string, schema string"
    )
    scored = scoring.score_models(rows, {"one": ("qwen", derived.FirstTablePredictor), "two": ("x", derived.FirstTablePredictor)})
    cleaned = evaluation.clean_predictions(scored).collect()
    assert {(r["ex_id"], r["model"], r["predicted_sql"]) for r in cleaned} == {
        (i, m, f"SELECT COUNT(*) FROM {t}") for i, t in ((1, "cats"), (2, "dogs")) for m in ("one", "two")
    }


def test_requests(spark):
    def make():
        def predictor(prompts):
            if any("boom" in p for p in prompts):
                raise ValueError("no luck")
            return ["```sql\nSELECT 1;\n```" for _ in prompts]
        return predictor

    rows = spark.createDataFrame([
        (1, " ", ""), (2, "q", "\n"), (3, "q", "s"), (4, "boom", "s"), (5, None, "s"),
    ], "ex_id long, question string, schema string").coalesce(1)
    got = {r["ex_id"]: (r["sql"], r["status"]) for r in scoring.answer_requests(rows, "m", make).collect()}
    assert got == {
        1: ("", fixed.STATUS_NO_QUESTION), 2: ("", fixed.STATUS_NO_SCHEMA), 3: ("SELECT 1", fixed.STATUS_OK),
        4: ("", "❌ Error: no luck"), 5: ("", fixed.STATUS_NO_QUESTION),
    }


def test_one_predictor_per_task(spark, tmp_path):
    mark = str(tmp_path / "made")

    def make():
        with open(mark, "a") as f:
            f.write("x")
        return lambda prompts: ["s" for _ in prompts]

    rows = spark.range(0, 30_000, 1, 2).select(F.col("id").alias("ex_id"), F.lit("q").alias("question"), F.lit("s").alias("schema"))
    assert scoring.score_batch(rows, "m", make).where("raw_text = 's'").count() == 30_000
    assert open(mark).read() == "xx"


# ---- reports, lines, batches ---------------------------------------------------------------------

def _report(spark, kind, n):
    results = spark.createDataFrame([(i, "m", None, None, None, False, True, 0.1, None, kind) for i in range(n)], schemas.RESULTS)
    return results, spark.createDataFrame([("m", n, 1.0, 1.0, 1.0, 1.0, {kind: n})], schemas.SUMMARY)


def test_readers_see_whole_reports(spark, tmp_path):
    folder = str(tmp_path / "report")
    with pytest.raises(tables.MissingInputError, match="report"):
        tables.read_report(spark, folder)
    assert tables.write_report(*_report(spark, "old", 2), folder) == 1
    results, summary = _report(spark, "new", 3)
    broken = summary.withColumn("model", F.raise_error(F.lit("stopped between the writes")))
    with pytest.raises(Exception, match="stopped between"):
        tables.write_report(results, broken, folder)

    def seen():
        rows, summary = tables.read_report(spark, folder)
        return {r["error_type"] for r in rows.collect()}, rows.count(), summary.first()["error_distribution"]

    assert seen() == ({"old"}, 2, {"old": 2})
    assert tables.write_report(results, summary, folder) == 2 and seen() == ({"new"}, 3, {"new": 3})
    assert tables.write_report(*_report(spark, "last", 1), folder) == 3 and seen() == ({"last"}, 1, {"last": 1})
    kept = [p.name for p in (tmp_path / "report").iterdir() if p.name.startswith("version=")]
    assert sum(n.startswith("version=1-") for n in kept) == 0 and sum(n.startswith("version=3-") for n in kept) == 1


def test_broken_lines_are_kept_aside(spark, tmp_path):
    lines = ['{"ex_id": 1, "question": "q"}', "", "  ", '{"ex_id": 2, "question"', "not json", "[1]", "3", '{"ex_id": "x"}', "{}", ' {"ex_id": 5, "more": [1], "answer": null}', "null"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(lines))
    rows, rejected = tables.read_jsonl_checked(spark, str(tmp_path / "in"), schemas.RAW_EXAMPLES)
    assert rows.schema == schemas.RAW_EXAMPLES and sorted((r["ex_id"], r["question"]) for r in rows.where("ex_id IS NOT NULL").collect()) == [(1, "q"), (5, None)]
    assert rows.count() == 3
    assert sorted(r["line"] for r in rejected.collect()) == sorted(['{"ex_id": 2, "question"', "not json", "[1]", "3", '{"ex_id": "x"}', "null"])
    for _ in range(2):
        tables.quarantine(rejected, str(tmp_path / "aside"))
    assert spark.read.json(str(tmp_path / "aside")).count() == 12
    with pytest.raises(tables.MissingInputError):
        tables.read_jsonl_checked(spark, str(tmp_path / "none"), schemas.RAW_EXAMPLES)


@pytest.mark.parametrize("budget, most", [(100, 8), (1, 3), (10**6, 1), (40, 100)])
def test_batches_by_length(budget, most):
    lengths = [5, 90, 0, 33, 33, 12, 200, 7, 7, 7, 1]
    found = scoring.batches_by_length(lengths, budget, most)
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))
    assert all(len(b) <= most and (len(b) == 1 or max(lengths[i] for i in b) * len(b) <= budget) for b in found)
    assert scoring.batches_by_length([], budget, most) == []


def test_answers_stay_with_their_prompts():
    calls = []

    def predictor(prompts):
        calls.append(len(prompts))
        if "boom" in prompts:
            raise ValueError
        return [p.upper() for p in prompts if p != "lost"] + ["x", "y"] * ("many" in prompts)

    got = scoring.ask(predictor, ["aaa", "boom", "b", "lost", "", "many", "cc"], budget=12, most_rows=4)
    assert got == [("AAA", None), (None, "ValueError"), ("B", None), (None, "0 answers to 1 prompts"), ("", None), (None, "3 answers to 1 prompts"), ("CC", None)]
    assert max(calls) == 4


def test_stored_prompts_and_errors(spark):
    rows = spark.createDataFrame([(i, f"p{i}" if i % 4 else None) for i in range(20)], "ex_id long, prompt string")
    make = lambda: lambda prompts: [p[::-1] for p in prompts if p != "p7"]
    got = {r["ex_id"]: (r["raw_text"], r["error"]) for r in scoring.score_batch(rows, "any", make, prompt="prompt", budget=5).collect()}
    assert got == {i: (None, "0 answers to 1 prompts") if i == 7 else (f"p{i}"[::-1] if i % 4 else "", None) for i in range(20)}
