"""Scores of one prediction against one gold text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlyard.functions.text import bound, col, tokens

MAX_ORDER = 4
_NO_MATCH = 0.1  # stands for zero matches of an order (smoothing method 1)


def word_codes(words: Column | str) -> Column:
    """A 64-bit number for every word: its hash, shifted by one to leave the last bit free."""
    return F.transform(col(words), lambda w: F.shiftleft(F.xxhash64(w), 1))


def code_runs(codes: Column | str, n: int) -> Column:
    """A number for every run of ``n`` neighbouring words, from their numbers."""
    if n == 1:
        return col(codes)
    return bound(col(codes), lambda all_: F.transform(
        F.slice(all_, 1, F.greatest(F.size(all_) - (n - 1), F.lit(0))),
        lambda c, i: F.shiftleft(F.xxhash64(c, *[F.get(all_, i + k) for k in range(1, n)]), 1)))


def unrepeated(codes: Column | str) -> Column:
    return F.size(F.array_distinct(col(codes))) == F.size(codes)


def clipped_matches(pred_runs: Column | str, gold_runs: Column | str) -> Column:
    """Size of the multiset intersection of two arrays of even numbers.

    Where either side repeats nothing, that is the size of the plain intersection, a hash lookup per element. Otherwise the numbers of
    both, gold ones plus one, are sorted together, and one walk lets each gold number use up one equal predicted one. Nothing is
    shuffled, no text is too long, and no value is larger than a long.
    """
    pred, gold = col(pred_runs), col(gold_runs)
    return F.when(unrepeated(gold) | unrepeated(pred), F.size(F.array_intersect(pred, gold))).otherwise(_walk_matches(pred, gold))


def _walk_matches(pred: Column, gold: Column) -> Column:
    both = F.sort_array(F.concat(pred, F.transform(gold, lambda c: c.bitwiseOR(F.lit(1).cast("long")))))

    def state(run: Column, free: Column, hits: Column) -> Column:
        return F.struct(run.alias("run"), free.alias("free"), hits.alias("hits"))

    def walk(s: Column, x: Column) -> Column:
        run, is_gold = x.bitwiseAND(F.lit(-2).cast("long")), x.bitwiseAND(F.lit(1).cast("long")) == 1
        free = F.when(s["run"] == run, s["free"]).otherwise(F.lit(0))
        return (
            F.when(~is_gold, state(run, free + 1, s["hits"]))
            .when(free > 0, state(run, free - 1, s["hits"] + 1))
            .otherwise(state(run, F.lit(0), s["hits"]))
        )

    start = state(F.lit(1).cast("long"), F.lit(0), F.lit(0))
    return F.aggregate(both, start, walk, lambda s: s["hits"])


def with_bleu(rows: DataFrame, pred_norm: str, gold_norm: str, name: str = "bleu") -> DataFrame:
    """Add sentence BLEU of two columns of normalised text: orders 1 to 4, equal weights, method-1 smoothing.

    Words become numbers once, and runs of words numbers of theirs, so that all that is compared and sorted is longs; two different
    words or runs share one with a chance of 2**-63. Each step is its own projection, so Spark computes words, runs and matches
    once. Equal texts
    match in full and get no numbers. A longer run can only match where a shorter one does, so an order is looked at
    only if the one before it hit; and where a side repeats no word, it repeats no run.
    """
    kept = rows.columns
    same, none = col(pred_norm) == col(gold_norm), F.array().cast("array<long>")
    work = rows.withColumns({"_p0": tokens(pred_norm), "_g0": tokens(gold_norm)})
    work = work.withColumns({
        "_p": F.size("_p0"), "_g": F.size("_g0"), **{f"_{s}1": F.when(same, none).otherwise(word_codes(f"_{s}0")) for s in "pg"}}).drop("_p0", "_g0")
    work = work.withColumn("_plain", ~same & (unrepeated("_g1") | unrepeated("_p1")))
    for n in range(1, MAX_ORDER + 1):
        open_ = ~same if n == 1 else ~same & (F.col(f"_hits{n - 1}") > 0)
        if n > 1:
            work = work.withColumns({
                f"_{side}{n}": F.when(open_, code_runs(f"_{side}1", n)).otherwise(none) for side in "pg"
            })
        full = F.greatest(F.col("_p") - (n - 1), F.lit(0))
        found = F.when(F.col("_plain"), F.size(F.array_intersect(f"_p{n}", f"_g{n}"))).otherwise(clipped_matches(f"_p{n}", f"_g{n}"))
        hits = F.when(same, full).when(open_, found).otherwise(F.lit(0))
        work = work.withColumn(f"_hits{n}", hits)
        if n > 1:
            work = work.drop(f"_p{n}", f"_g{n}")

    def log_precision(n: int) -> Column:
        hits = F.col(f"_hits{n}").cast("double")
        runs = F.greatest(F.col("_p") - (n - 1), F.lit(1))
        return F.log(F.when(hits > 0, hits).otherwise(F.lit(_NO_MATCH)) / runs)

    mean = reduce(Column.__add__, [log_precision(n) for n in range(1, MAX_ORDER + 1)]) / MAX_ORDER
    brevity = F.when(F.col("_p") > F.col("_g"), F.lit(0.0)).otherwise(1 - F.col("_g") / F.greatest("_p", F.lit(1)))
    # no shared word (so also an empty side) scores zero
    score = F.when(F.col("_hits1") > 0, F.exp(brevity + mean)).otherwise(F.lit(0.0))
    return work.select(*kept, score.alias(name))
