import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sqlyard.operators import runs
from sqlyard.streaming.plateau import OUTPUT, _Walk, keep_state_on_disk, plateau_stream

TRACE = [(200, 0.05831), (400, 0.05948), (600, 0.05878), (800, 0.06115), (1000, 0.06497), (1200, 0.11050)]
LOG = "run_id string, step long, eval_loss double"


def walk(points, patience=5, min_delta=0.001):
    """The rule in plain Python: (best, wait, stop, low, low_step, n, last)."""
    best, wait, low, low_step, n, last = None, 0, None, None, 0, None
    for step, loss in sorted(points, key=lambda p: p[0]):
        if loss is None:
            continue
        n, last = n + 1, step
        if low is None or loss < low:
            low, low_step = loss, step
        if best is None or loss < best - min_delta:
            best, wait = loss, 0
        else:
            wait += 1
            if wait >= patience:
                return best, wait, step, low, low_step, n, last
    return best, wait, None, low, low_step, n, last


def result(r):
    return (r["best_loss"], r["wait"], r["stop_step"], r["low_loss"], r["low_step"], r["n_evals"], r["last_step"])


def test_published_trace(spark):
    log = spark.createDataFrame([("v2", s, v) for s, v in TRACE + [(1400, 0.01)]], LOG)
    r = runs.plateau(log).first()
    assert (r["best_loss"], r["stop_step"], r["wait"], r["stopped"]) == (0.05831, 1200, 5, True)
    s = runs.run_summary(log, steps_per_epoch=1250).first()
    assert (s["best_eval_loss"], s["best_step"], s["last_step"], s["last_epoch"], s["early_stopped"]) == (0.05831, 200, 1200, 0.96, True)


@pytest.mark.parametrize("piece", [2, 3, 7, 4096])
@pytest.mark.parametrize("patience", [1, 2, 5])
def test_plateau_in_pieces(spark, piece, patience):
    rng = random.Random(piece * 10 + patience)
    logs = {}
    for i in range(120):
        level, points = 10.0, []
        for k in range(rng.randint(1, 40)):
            level -= rng.choice([0.0, 0.0005, 0.5, 0.5, -0.2])
            points.append((k * rng.choice([1, 1, 3]) + i, rng.choice([level, level, level + rng.random(), None])))
        logs[f"r{i}"] = list({s: (s, v) for s, v in points}.values())
    logs["falling"] = [(s, 100.0 - s) for s in range(60)]  # never stops
    rows = [(r, s, v) for r, points in logs.items() for s, v in points]
    rng.shuffle(rows)
    got = {r["run_id"]: result(r) for r in runs.plateau(spark.createDataFrame(rows, LOG), patience, piece=piece).collect()}
    want = {r: walk(p, patience) for r, p in logs.items() if any(v is not None for _, v in p)}
    assert got == want


def test_small_gains_do_not_move_the_best(spark):
    points = [(i, 1.0 - 0.0005 * i) for i in range(20)]
    r = runs.plateau(spark.createDataFrame([("a", s, v) for s, v in points], LOG)).first()
    assert result(r) == walk(points) and r["stop_step"] is None and r["best_loss"] != r["low_loss"]


def test_nan_never_improves_and_is_never_improved_on(spark):
    nan = float("nan")
    points = {"first": [nan, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0], "later": [0.5, nan, 0.4, nan, nan, nan, nan, nan, 0.1]}
    log = spark.createDataFrame([(r, i, v) for r, vs in points.items() for i, v in enumerate(vs)], LOG)
    got = {r["run_id"]: (r["stop_step"], r["wait"], str(r["best_loss"])) for r in runs.plateau(log).collect()}
    assert got == {r: (w[2], w[1], str(w[0])) for r, w in ((r, walk(list(enumerate(vs)))) for r, vs in points.items())}


def test_checkpoints(spark):
    log = spark.createDataFrame(
        [("a", s, v) for s, v in ((1, 0.9), (2, 0.1), (3, 0.5), (4, 0.1), (5, 0.7))] + [("b", 1, 0.3), ("c", 1, None), ("c", 2, 2.0)], LOG
    )
    best = {r["run_id"]: (r["best_step"], r["best_loss"]) for r in runs.best_checkpoint(log).collect()}
    assert best == {"a": (2, 0.1), "b": (1, 0.3), "c": (2, 2.0)}
    kept = {}
    for r in runs.retained_checkpoints(log, 3).collect():
        kept.setdefault(r["run_id"], {})[r["keep_rank"]] = r["step"]
    assert kept == {"a": {1: 2, 2: 5, 3: 4}, "b": {1: 1}, "c": {1: 2, 2: 1}}
    only = {r["run_id"]: r["step"] for r in runs.retained_checkpoints(log, 1).collect()}
    assert only == {"a": 2, "b": 1, "c": 2}


@pytest.mark.parametrize("bucket", [1, 2, 5, 65536])
def test_history(spark, bucket):
    values = {1: 8.0, 2: 22.0, 3: 94.0, 10: 90.0, 11: None, 30: 1.0}
    df = spark.createDataFrame(list(values.items()), "run_no int, acc double")
    got = {r["run_no"]: r["acc_change"] for r in runs.run_history(df, "run_no", ["acc"], bucket).collect()}
    assert got == {1: None, 2: 14.0, 3: 72.0, 10: -4.0, 11: None, 30: None}


def _stream(spark, folder, name, **settings):
    keep_state_on_disk(spark)
    spark.conf.set("spark.sql.shuffle.partitions", 1)  # a Python worker starts per partition and batch
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    query = (
        plateau_stream(log, **settings).writeStream.format("parquet").option("path", str(folder / name))
        .option("checkpointLocation", str(folder / f"{name}-progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    return spark.read.parquet(str(folder / name))


def _file(spark, folder, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def _walked(found, run):
    return [(r["step"], r["wait"], r["best_loss"], r["stopped"]) for r in found.where(f"run_id = '{run}' AND NOT late").orderBy("step").collect()]


def test_stream_over_many_batches(spark, tmp_path):
    trace = [("v2", step, loss) for step, loss in TRACE + [(1400, 0.001)]]
    for rows in (trace[:2], trace[2:3] + [("other", 2, 0.4), ("other", 1, 0.5)], trace[3:]):
        _file(spark, tmp_path, rows)
    found = _stream(spark, tmp_path, "waits")
    assert _walked(found, "v2") == [(s, i, 0.05831, i == 5) for i, (s, _) in enumerate(TRACE)]
    assert _walked(found, "other") == [(1, 0, 0.5, False), (2, 0, 0.4, False)]


def test_stream_of_shuffled_files(spark, tmp_path):
    """Any order gives what the batch gives, once a run has ended; what comes after its turn is late."""
    rng = random.Random(2)
    rows = [(f"r{k}", step, rng.choice((1 / step, 0.5, 2.0, float("nan")))) for k in range(4) for step in range(1, 40)]
    rng.shuffle(rows)
    for part in range(2):
        _file(spark, tmp_path, rows[part::2] + [("r0", 50, None)])
    waiting = _stream(spark, tmp_path, "rows", lag=None, bucket=8)
    assert waiting.count() == 0
    _file(spark, tmp_path, [(f"r{k}", None, None) for k in range(3)])
    found = _stream(spark, tmp_path, "rows", lag=None, bucket=8).where("NOT late")
    whole = {r["run_id"]: r for r in runs.plateau(spark.createDataFrame(rows, LOG)).collect()}
    assert {r["run_id"] for r in found.collect()} == {"r0", "r1", "r2"}
    for r in found.groupBy("run_id").agg(F.max("step").alias("last"), F.count("*").alias("n"), F.max_by("best_loss", "step").alias("best"), F.max_by("wait", "step").alias("wait")).collect():
        assert (r["last"], r["n"], r["wait"]) == tuple(whole[r["run_id"]][c] for c in ("last_step", "n_evals", "wait"))


def test_stream_says_what_is_late(spark, tmp_path):
    for steps in ((5, 3), (4, 9), (8, 1, 12), (11, 6)):
        _file(spark, tmp_path, [("a", s, 1.0 / s) for s in steps])
    found = _stream(spark, tmp_path, "lagged", lag=2)
    assert [s for s, *_ in _walked(found, "a")] == [3, 4, 5, 8, 9]  # 11 and 12 wait on
    late = {r["step"]: (r["best_loss"], r["wait"], r["stopped"]) for r in found.where("late").collect()}
    assert late == {1: (None, None, None), 6: (None, None, None)}


def test_stream_lets_idle_runs_go(spark, tmp_path):
    _file(spark, tmp_path, [("a", 2, 0.5), ("a", 1, 1.0)])
    keep_state_on_disk(spark)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    log = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    query = (
        plateau_stream(log, lag=None, idle_ms=1).writeStream.format("parquet").option("path", str(tmp_path / "idle"))
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(processingTime="1 second").start()
    )
    try:
        end, found = time.time() + 90, []
        while not found and time.time() < end:
            time.sleep(1)
            found = _walked(spark.read.schema(OUTPUT).parquet(str(tmp_path / "idle")), "a") if (tmp_path / "idle").exists() else []
    finally:
        query.stop()
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert found == [(1, 0, 1.0, False), (2, 0, 0.5, False)]


def test_hot_run_is_shared_among_tasks(spark):
    """The log of one run spreads over the first grouping's tasks."""
    log = spark.range(20_000).select(F.lit("hot").alias("run_id"), F.col("id").alias("step"), (20_000 - F.col("id")).cast("double").alias("eval_loss"))
    r = runs.plateau(log, piece=512).first()
    assert (r["n_evals"], r["stop_step"], r["best_loss"]) == (20_000, None, 1.0)


class _Held(dict):
    """A state variable in plain Python that counts its calls."""

    calls, value = 0, None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class _Handle:
    def getValueState(self, name, schema):
        self.walk = _Held()
        return self.walk

    def getMapState(self, name, key, value):
        self.waiting = _Held()
        return self.waiting


def test_stream_calls_its_state_by_evaluations_not_by_steps():
    """Each call is a round trip: a short run over far steps makes a few, and a long run's buckets stay small."""
    def frame(steps, losses):
        return pd.DataFrame({"step": steps, "eval_loss": losses})

    def walked(steps, parts, bucket):
        handle, walk = _Handle(), _Walk(10**6, 0.0, None, None, bucket)
        walk.init(handle)
        for part in np.array_split(steps, parts):
            assert not list(walk.handleInputRows(("r",), iter([frame(part, np.sin(part))]), None))
        held, calls = dict(handle.waiting), handle.walk.calls + handle.waiting.calls
        out = pd.concat(walk.handleInputRows(("r",), iter([frame([None], [None])]), None))
        assert out["step"].tolist() == sorted(steps.tolist())
        assert out["best_loss"].tolist() == np.minimum.accumulate(np.sin(np.sort(steps))).tolist()
        assert not handle.waiting
        return held, calls

    mixed = np.random.default_rng(7).permutation(np.concatenate([np.arange(500), np.full(40, 77), -np.arange(1, 200) * 1000]))
    held, calls = walked(np.arange(70, 0, -1) * 5000, 1, 4096)
    assert len(held) == 1 and calls <= 3
    held, _ = walked(mixed, 9, 16)
    assert len(held) > 20 and max(len(v[0]) // 8 for v in held.values()) <= 40 + 2 * 16
