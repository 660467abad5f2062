"""Metric logs ``(run_id, step, eval_loss)``: plateau, best and kept checkpoints, run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PATIENCE = 5
MIN_DELTA = 0.001

_STATE = "struct<best:double,wait:int,stop:bigint,low:double,low_step:bigint,n:bigint,last:bigint>"


# ---- plateau ----------------------------------------------------------------------------------
#
# The rule is a walk in step order with memory: an evaluation is an improvement only against the
# last improvement, by more than ``min_delta``; ``patience`` others in a row end the run. A running
# minimum cannot express it. A run may be far larger than a task, so the walk is cut in pieces:
#
# * a piece is a stretch of consecutive steps of one run;
# * whatever the walk brings into a piece, it either improves at one of the piece's first
#   ``patience`` evaluations or ends by then;
# * so a piece is fully described by those few evaluations, each with the state the walk would
#   leave the piece in, had it improved there.
#
# Pieces join to larger pieces of the same small size. Two rounds of pieces leave one short list
# per run. No group ever holds more than ``piece`` entries while steps stay below piece**3.

def _struct(best, wait, stop, low, low_step, n, last) -> Column:
    return F.struct(
        best.cast("double").alias("best"), wait.cast("int").alias("wait"), stop.cast("long").alias("stop"),
        low.cast("double").alias("low"), low_step.cast("long").alias("low_step"), n.cast("long").alias("n"),
        last.cast("long").alias("last"),
    )


def _improved_at(step: Column, loss: Column) -> Column:
    return _struct(loss, F.lit(0), F.lit(None), loss, step, F.lit(1), step)


def _follow(before: Column, after: Column) -> Column:
    """State after a stretch that began with an improvement."""
    lower = before["low"].isNull() | (after["low"] < before["low"])
    return _struct(
        after["best"], after["wait"], after["stop"],
        F.when(lower, after["low"]).otherwise(before["low"]),
        F.when(lower, after["low_step"]).otherwise(before["low_step"]),
        before["n"] + after["n"], after["last"],
    )


def _no_gain(s: Column, step: Column, loss: Column, patience: int) -> Column:
    lower = loss < s["low"]
    return _struct(
        s["best"], s["wait"] + 1, F.when(s["wait"] + 1 >= patience, step),
        F.when(lower, loss).otherwise(s["low"]), F.when(lower, step).otherwise(s["low_step"]),
        s["n"] + 1, step,
    )


def _through_piece(state: Column, head: Column, patience: int, min_delta: float) -> Column:
    """State after a piece, from the state before it and the piece's first evaluations."""
    def meet(acc: Column, e: Column) -> Column:
        s = acc["s"]
        # Spark sorts NaN above every number; as a loss nothing is lower than it
        lower = (e["loss"] < s["best"] - F.lit(min_delta)) & ~F.isnan(s["best"])
        gain = s["best"].isNull() | lower
        return (
            F.when(acc["done"] | s["stop"].isNotNull(), acc)
            .when(gain, F.struct(_follow(s, e["tail"]).alias("s"), F.lit(True).alias("done")))
            .otherwise(F.struct(_no_gain(s, e["step"], e["loss"], patience).alias("s"), F.lit(False).alias("done")))
        )

    start = F.struct(state.alias("s"), F.lit(False).alias("done"))
    return F.aggregate(head, start, meet, lambda acc: acc["s"])


def _single(e: Column) -> Column:
    """One evaluation as a piece."""
    head = F.struct(e["step"].alias("step"), e["loss"].alias("loss"), _improved_at(e["step"], e["loss"]).alias("tail"))
    return F.struct(e["step"].alias("pos"), F.array(head).alias("head"))


def _joined(parts: DataFrame, patience: int, min_delta: float) -> DataFrame:
    """``(run_id, pos, parts)``, parts in step order, to one piece ``(run_id, pos, head)`` each."""
    def tail(e: Column, part_no: Column) -> Column:
        later = F.filter("parts", lambda p, i: i > part_no)
        return F.aggregate(later, e["tail"], lambda s, p: _through_piece(s, p["head"], patience, min_delta))

    firsts = F.slice(F.flatten(F.transform(
        F.slice("parts", 1, patience),  # every part holds at least one evaluation
        lambda p, i: F.transform(p["head"], lambda e: F.struct(i.alias("part"), e.alias("e"))),
    )), 1, patience)
    return parts.withColumn("firsts", firsts).select("run_id", "pos", F.transform("firsts", lambda f: F.struct(
        f["e"]["step"].alias("step"), f["e"]["loss"].alias("loss"), tail(f["e"], f["part"]).alias("tail"),
    )).alias("head"))


def plateau(
    log: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA, piece: int = 4096
) -> DataFrame:
    """Per run: where it stops and what it reached by then. Steps are unique within a run.

    ``best_loss`` is the last improvement (by more than ``min_delta``), ``wait`` the evaluations
    since; ``stop_step`` is null for a run that did not stop. ``low_loss`` at ``low_step`` is the
    lowest loss seen, ``n_evals`` and ``last_step`` count up to the stop. Rows without a loss
    are skipped, rows after the stop ignored.
    """
    def stretch(position: str) -> Column:
        return F.floor(F.col(position) / piece).alias("pos")

    # only step and loss move in the first shuffle
    evaluations = log.where(F.col("eval_loss").isNotNull()).select(
        "run_id", F.col("step").cast("long").alias("step"), F.col("eval_loss").cast("double").alias("loss")
    )
    first = evaluations.groupBy("run_id", stretch("step")).agg(
        F.sort_array(F.collect_list(F.struct("step", "loss"))).alias("parts")
    ).withColumn("parts", F.transform("parts", _single))
    second = _joined(first, patience, min_delta).groupBy("run_id", stretch("pos")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "head"))).alias("parts")
    )
    pieces = _joined(second, patience, min_delta)
    none = F.lit(None)
    start = _struct(none, F.lit(0), none, none, none, F.lit(0), none)
    end = F.aggregate(
        F.sort_array(F.collect_list(F.struct("pos", "head"))), start,
        lambda s, p: _through_piece(s, p["head"], patience, min_delta),
    )
    return (
        pieces.groupBy("run_id").agg(end.cast(_STATE).alias("s"))
        .select(
            "run_id", F.col("s.best").alias("best_loss"), F.col("s.wait").alias("wait"),
            F.col("s.stop").alias("stop_step"), F.col("s.stop").isNotNull().alias("stopped"),
            F.col("s.low").alias("low_loss"), F.col("s.low_step").alias("low_step"),
            F.col("s.n").alias("n_evals"), F.col("s.last").alias("last_step"),
        )
    )


# ---- checkpoints ------------------------------------------------------------------------------

def best_checkpoint(log: DataFrame) -> DataFrame:
    """Step with the lowest loss per run, the earliest of equals."""
    return (
        log.where(F.col("eval_loss").isNotNull()).groupBy("run_id")
        .agg(F.min(F.struct("eval_loss", "step")).alias("_b"))
        .select("run_id", F.col("_b.step").alias("best_step"), F.col("_b.eval_loss").alias("best_loss"))
    )


def retained_checkpoints(log: DataFrame, limit: int = 3) -> DataFrame:
    """At most ``limit`` checkpoints per run: the best one, then the latest.

    The literal rank filter lets every task drop all but ``limit`` rows of a run before the
    shuffle, and the best step is a plain minimum, so a large run costs no more than a small one.
    """
    saved = log.select("run_id", "step", "eval_loss")
    latest = (
        saved.withColumn("_r", F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("step"))))
        .where(F.col("_r") <= limit).drop("_r")
    )
    best = best_checkpoint(saved).select("run_id", F.col("best_step").alias("step"), F.col("best_loss").alias("eval_loss"))
    # at most limit + 1 rows per run from here on
    both = (
        latest.withColumn("_best", F.lit(False)).unionByName(best.withColumn("_best", F.lit(True)))
        .groupBy("run_id", "step").agg(F.max("eval_loss").alias("eval_loss"), F.max("_best").alias("is_best"))
    )
    keep = Window.partitionBy("run_id").orderBy(F.desc("is_best"), F.desc("step"))
    return (
        both.withColumn("keep_rank", F.row_number().over(keep))
        .where(F.col("keep_rank") <= limit)
    )


# ---- runs -------------------------------------------------------------------------------------

def run_summary(
    log: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
    steps_per_epoch: int | None = None,
) -> DataFrame:
    """Per run: lowest loss and its step, last step (and epoch), stopped early or not."""
    ended = plateau(log, patience, min_delta)
    columns = ["run_id", F.col("low_loss").alias("best_eval_loss"), F.col("low_step").alias("best_step"),
               "last_step", "n_evals", F.col("stopped").alias("early_stopped")]
    if steps_per_epoch:
        columns.append((F.col("last_step") / steps_per_epoch).alias("last_epoch"))
    return ended.select(*columns)


def run_history(runs: DataFrame, order: str, metrics: list[str], bucket: int = 65536) -> DataFrame:
    """Each run's metrics beside their change from the run before it in ``order`` (unique whole numbers).

    One global order without one global task: runs are compared within stretches of ``bucket``
    order values, and each stretch's first run with the last run of the stretch before. Only
    that last step is a single sorted list, one row per stretch.
    """
    values = F.struct(*metrics)
    staged = runs.withColumn("_part", F.floor(F.col(order) / bucket))
    within = Window.partitionBy("_part").orderBy(order)
    ends = staged.groupBy("_part").agg(F.max_by(values, F.col(order)).alias("_end"))
    carried = ends.select(
        "_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carry")
    ).where(F.col("_carry").isNotNull())
    return (
        staged.withColumn("_lag", F.lag(values).over(within))
        .join(carried, "_part", "left")
        .withColumn("_prev", F.coalesce("_lag", "_carry"))
        .select(*runs.columns, *[(F.col(m) - F.col(f"_prev.{m}")).alias(f"{m}_change") for m in metrics])
    )
