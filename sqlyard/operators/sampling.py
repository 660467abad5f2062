"""Splits, caps and samples. Rows carry a key, and order always means an order of keys."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.functions import fixed
from sqlyard.functions.text import col

_BUCKET_DIGITS = 4  # 65,536 buckets: the bound on every bucket table below


def shuffle_key(key: Column | str, seed: int = fixed.DEFAULT_SEED) -> Column:
    """Stable pseudo-random order of rows: the hex digest of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col(key).cast("string")))


def split_column(
    key: Column | str, test_size: float = fixed.DEFAULT_TEST_SIZE, seed: int = fixed.DEFAULT_SEED
) -> Column:
    """``test`` for the share ``test_size`` of keys, else ``train``; no shuffle, stable per key."""
    limit = ceil(test_size * 2 ** 32)
    if limit >= 2 ** 32:
        return F.lit("test")
    # hex digests order like the numbers they spell
    in_test = F.substring(shuffle_key(key, seed), 1, 8) < f"{limit:08x}"
    return F.when(in_test, "test").otherwise("train")


def train_test_split(
    rows: DataFrame, test_size: float = fixed.DEFAULT_TEST_SIZE, seed: int = fixed.DEFAULT_SEED,
    key: str = "ex_id",
) -> DataFrame:
    return rows.withColumn("split", split_column(key, test_size, seed))


def _with_order(rows: DataFrame, seed: int, key: str) -> DataFrame:
    return rows.withColumn("_order", F.struct(shuffle_key(key, seed).alias("h"), F.col(key).alias("k")))


def _first_out(ordered: DataFrame, size: Column) -> DataFrame:
    """``(split, _out)``: the first key, in shuffled order, beyond the ``size`` wanted of each split.

    A split with no more rows than wanted has none. No sort of the table, whatever the size: keys
    are counted per digest prefix, which shows the prefix in which the size is reached, and only
    that prefix (1/65,536 of the keys) is ranked. Both passes read the key column alone.
    ``size`` may use ``_total``, the rows of the split.
    """
    keys = ordered.select("split", "_order", F.substring("_order.h", 1, _BUCKET_DIGITS).alias("_bucket"))
    # windows over at most 65,536 counts per split
    whole = Window.partitionBy("split")
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        keys.groupBy("split", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_room", size - F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where((F.col("_room") >= 0) & (F.col("_room") < F.col("_n")))
        .select("split", "_bucket", "_room")
    )  # one prefix per split at most
    return (
        keys.join(F.broadcast(edge), ["split", "_bucket"])
        .withColumn("_rank", F.row_number().over(whole.orderBy("_order")))
        .where(F.col("_rank") == F.col("_room") + 1)
        .select("split", F.col("_order").alias("_out"))
    )


def exact_split(
    rows: DataFrame, test_size: float = fixed.DEFAULT_TEST_SIZE, seed: int = fixed.DEFAULT_SEED,
    key: str = "ex_id",
) -> DataFrame:
    """Like ``train_test_split`` with exactly ``ceil(test_size * rows)`` test rows.

    Costs two passes over the keys; a row's side can change when the table grows.
    """
    ordered = _with_order(rows, seed, key)
    wanted = F.ceil(F.col("_total") * F.lit(test_size))
    first_out = _first_out(ordered.withColumn("split", F.lit("all")), wanted)
    out = first_out.select("_out").scalar()  # one key; null when every row is wanted
    in_test = out.isNull() | (F.col("_order") < out)
    return ordered.withColumn("split", F.when(in_test, "test").otherwise("train")).select(*rows.columns, "split")


def cap_splits(
    rows: DataFrame, caps: dict[str, int], seed: int = fixed.DEFAULT_SEED, key: str = "ex_id"
) -> DataFrame:
    """At most ``caps[split]`` rows per split: the first ones in shuffled order. Others stay whole.

    After two narrow passes over the keys the wide rows are only filtered, against one key per split.
    """
    if not caps:
        return rows
    size = F.lit(None).cast("long")
    for split, n in caps.items():
        size = F.when(F.col("split") == split, F.lit(n)).otherwise(size)
    ordered = _with_order(rows, seed, key)
    first_out = _first_out(ordered.where(F.col("split").isin(list(caps))), size)
    return (
        ordered.join(F.broadcast(first_out), "split", "left")
        .where(F.col("_out").isNull() | (F.col("_order") < F.col("_out")))
        .select(*rows.columns)
    )


def first_rows(rows: DataFrame, n: int, *order: Column | str, fan_in: int = 1024) -> DataFrame:
    """The first ``n`` rows by ``order``, in two steps so that no task sees every task's candidates.

    Each task keeps its own first ``n`` rows, groups of tasks keep theirs, then one task merges
    at most ``n * fan_in`` rows. For small ``n``: beyond 1,000 Spark ranks after the shuffle instead
    of before it. ``cap_splits`` has no such limit.
    """
    keys = [col(c) for c in order]
    group = Window.partitionBy("_group").orderBy(*keys)
    return (
        rows.withColumn("_group", F.spark_partition_id() % fan_in)
        .withColumn("_rank", F.row_number().over(group))
        .where(F.col("_rank") <= n)
        .drop("_group", "_rank")
        .orderBy(*keys)
        .limit(n)
    )


def first_by_key(rows: DataFrame, n: int, key: str = "ex_id") -> DataFrame:
    """The ``n`` rows with the smallest whole-number keys, for any ``n``; rows without a key are none of them.

    The n-th key is found by its digits: keys are counted by their first 16 bits, which shows the prefix in which n is reached, then
    only keys of that prefix by their next 16 bits, and so on. Four passes read the key alone; every table between holds 65,536
    counts at most; and the wide rows are filtered where they are read, never shuffled or sorted. Of rows that share the n-th
    key, as many stay as are wanted, by a hash of the whole row.
    """
    if n <= 0:
        return rows.limit(0)

    def digits(bits: int) -> Column:
        """The key's first bits as a number; the sign is turned over, so they order as keys do."""
        return F.shiftrightunsigned(F.col(key).cast("long").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)

    keys = rows.where(F.col(key).isNotNull()).select(key)
    found = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("_prefix"), F.lit(n).cast("long").alias("_room"))
    earlier = Window.orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)  # over 65,536 counts at most
    for bits in (16, 32, 48, 64):
        open_ = digits(bits - 16) if bits > 16 else F.lit(0).cast("long")
        counts = keys.withColumn("_prefix", open_).join(F.broadcast(found), "_prefix").groupBy(digits(bits).alias("_digits"), "_room").agg(F.count("*").alias("_n"))
        found = counts.withColumn("_left", F.col("_room") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where(
            (F.col("_left") > 0) & (F.col("_left") <= F.col("_n"))).select(F.col("_digits").alias("_prefix"), F.col("_left").alias("_room"))
    # no n-th key where there are fewer rows: all of them stay
    edge = found.agg(F.max("_prefix").alias("_prefix"), F.max("_room").alias("_room"))
    last = edge.select(F.col("_prefix").bitwiseXOR(F.lit(-(1 << 63))).alias("k"))
    nth, room = last.scalar(), edge.select("_room").scalar()
    below = rows.where(F.col(key).isNotNull() & (nth.isNull() | (F.col(key) < nth)))
    rank = F.row_number().over(Window.orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])))
    ties = rows.where(F.col(key) == nth).withColumn("_rank", rank).where(F.col("_rank") <= room).drop("_rank")
    return below.union(ties)


def random_sample(rows: DataFrame, n: int, key: str, seed: int = fixed.DEFAULT_SEED) -> DataFrame:
    """``n`` rows that look random and are the same for a seed."""
    return first_rows(rows, n, shuffle_key(key, seed), F.col(key))


def row_at(rows: DataFrame, key_value: int, key: str = "ex_id") -> DataFrame:
    """The row with a key; the filter reaches the scan."""
    return rows.where(F.col(key) == key_value)
