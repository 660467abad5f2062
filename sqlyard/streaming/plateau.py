"""The plateau rule on a stream of evaluations that come in any order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sqlyard.operators.runs import MIN_DELTA, PATIENCE

OUTPUT = "run_id string, step long, eval_loss double, best_loss double, wait int, stopped boolean, late boolean"
_COLUMNS = [part.split()[0] for part in OUTPUT.split(", ")]


def keep_state_on_disk(spark: SparkSession) -> None:
    """The state store that ``plateau_stream`` needs, for queries that this session starts from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Walk(StatefulProcessor):
    """Evaluations wait in the state, in buckets of neighbouring steps, until their turn; then the rule walks over them in order.

    A bucket is split when it holds more than two buckets' evaluations, whatever their steps are, so a short run has one. Its name is
    no more than its least step; the names of a run's buckets, in order, lie beside the walk. Each call of the state is a round trip, so a
    batch makes one for the walk, one to store it, and two for each bucket it touches.
    """

    def __init__(self, patience: int, min_delta: float, lag: int | None, idle_ms: int | None, bucket: int):
        self.patience, self.min_delta, self.lag, self.idle_ms, self.bucket = patience, min_delta, lag, idle_ms, bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.walk = handle.getValueState("walk", "best double, wait int, stopped boolean, released long, seen long, buckets binary")
        self.waiting = handle.getMapState("waiting", "bucket long", "steps binary, losses binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best, wait, stopped, released, seen, names = self._state() or (None, 0, False, None, None, [])
        ended = False
        for part in rows:
            if stopped:  # nothing is kept of a run that has ended
                continue
            given = part["step"].notna().to_numpy()
            if not given.all():
                ended, part = True, part[given]
            steps, losses = part["step"].to_numpy(np.int64), part["eval_loss"].to_numpy(np.float64)
            late = steps <= released if released is not None else np.zeros(len(steps), bool)
            if late.any():
                yield _rows(key[0], [(int(s), float(x), None, None, None, True) for s, x in zip(steps[late], losses[late])])
                steps, losses = steps[~late], losses[~late]
            if len(steps):
                names = self._keep(names, steps, losses)
                seen = max(int(steps.max()), seen if seen is not None else int(steps.max()))
        if stopped:
            return
        limit = None if ended else seen - self.lag if self.lag is not None and seen is not None else -np.inf
        yield from self._release(key, (best, wait, stopped, released, seen, names), limit)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._state()
        if state and not state[2]:
            yield from self._release(key, state, None)

    def close(self) -> None:
        pass

    def _state(self) -> tuple | None:
        held = self.walk.get()
        return held and (*held[:5], np.frombuffer(held[5], np.int64).tolist())

    def _take(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        held = self.waiting.getValue((b,))
        return np.frombuffer(held[0], np.int64), np.frombuffer(held[1], np.float64)

    def _put(self, b: int, steps: np.ndarray, losses: np.ndarray) -> None:
        self.waiting.updateValue((b,), (steps.tobytes(), losses.tobytes()))

    def _keep(self, names: list[int], steps: np.ndarray, losses: np.ndarray) -> list[int]:
        """Adds evaluations to their buckets and returns the buckets' names; equal steps stay in one bucket, in order of arrival."""
        least = int(steps.min())
        place = np.maximum(np.searchsorted(np.array(names, np.int64), steps, "right") - 1, 0)
        out = list(names[:int(place.min())])
        for i in range(len(out), max(len(names), 1)):
            mine = place == i
            if not mine.any():
                out.append(names[i])
                continue
            bucket, name = (steps[mine], losses[mine]), least
            if i < len(names):
                bucket = tuple(np.concatenate(pair) for pair in zip(self._take(names[i]), bucket))
                name = min(least, names[0]) if i == 0 else names[i]
                if name < names[i]:
                    self.waiting.removeKey((names[i],))
            out += self._split(name, *bucket)
        return out

    def _split(self, name: int, steps: np.ndarray, losses: np.ndarray) -> list[int]:
        """Stores a bucket, in several where it has grown too large."""
        cuts = [0]
        if len(steps) > 2 * self.bucket:
            order = np.argsort(steps, kind="stable")
            steps, losses = steps[order], losses[order]
            # a cut stands before the first of equal steps
            cuts = sorted({0, *np.searchsorted(steps, steps[self.bucket::self.bucket]).tolist()})
        found = [name] + steps[cuts[1:]].tolist()
        for b, begin, end in zip(found, cuts, [*cuts[1:], len(steps)]):
            self._put(b, steps[begin:end], losses[begin:end])
        return found

    def _release(self, key, state, limit) -> Iterator[pd.DataFrame]:
        """Walks over what waits, up to a step or all of it, a bucket at a time."""
        best, wait, stopped, released, seen, names = state
        kept = list(names)
        for b in names if limit is None or limit > -np.inf else ():
            if stopped or limit is not None and b > limit:
                break
            steps, losses = self._take(b)
            order = np.argsort(steps, kind="stable")
            steps, losses = steps[order], losses[order]
            due = len(steps) if limit is None else int(np.searchsorted(steps, limit, "right"))
            out = []
            for step, loss in zip(steps[:due].tolist(), losses[:due].tolist()):
                if best is None or loss < best - self.min_delta:
                    best, wait = loss, 0
                else:
                    wait += 1
                    stopped = wait >= self.patience
                out.append((step, loss, best, wait, stopped, False))
                released = step
                if stopped:
                    break
            if due < len(steps):
                self._put(b, steps[due:], losses[due:])
            else:
                self.waiting.removeKey((b,))
                kept.remove(b)
            if out:
                yield _rows(key[0], out)
        if stopped:
            self.waiting.clear()
            kept = []
        self.walk.update((best, wait, stopped, released, seen, np.array(kept, np.int64).tobytes()))


def _rows(run_id: str, rows: list[tuple]) -> pd.DataFrame:
    columns = [np.array(c, dtype=object) if name in ("best_loss", "wait", "stopped") else list(c) for name, c in zip(_COLUMNS[1:], zip(*rows))]
    return pd.DataFrame({"run_id": [run_id] * len(rows), **dict(zip(_COLUMNS[1:], columns))})


def plateau_stream(
    log: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA, lag: int | None = 0, idle_ms: int | None = None, bucket: int = 4096,
) -> DataFrame:
    """One row per evaluation with the run's state after it; nothing after a run's stop.

    Evaluations may come in any order. One waits in the state until another of its run that is ``lag`` steps further on has arrived,
    with ``lag`` None until the run's end, and then has its turn in order of steps. A row without a step and a loss says that its run
    has ended, and so does, with ``idle_ms``, that time without an evaluation: all that waits has its turn. An evaluation behind
    one that had its turn comes out as ``late``, with no state, and changes nothing. Other rows without a loss are skipped.

    Waiting evaluations lie in buckets of about ``bucket`` neighbouring ones; a batch is read chunk by chunk and the walk holds one bucket, so
    no run's batch, nor all that waits of it, is in memory at once. The state needs ``keep_state_on_disk``;
    ``idle_ms`` needs a trigger that goes on, since Spark keeps a query with timers of this kind from ever having taken all there is.
    """
    evaluations = log.where(log["eval_loss"].isNotNull() | log["step"].isNull())
    found = evaluations.select("run_id", F.col("step").cast("long").alias("step"), F.col("eval_loss").cast("double").alias("eval_loss"))
    return found.groupBy("run_id").transformWithStateInPandas(
        _Walk(patience, min_delta, lag, idle_ms, bucket), OUTPUT, "append", "None" if idle_ms is None else "ProcessingTime")
