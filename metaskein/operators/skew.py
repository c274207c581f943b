"""Joins and numberings that hold when one key has a large share of all rows.

Spark's adaptive skew join splits a hot partition if both inputs of the join have a shuffle of their own. An input that
is an aggregate on the join's keys has none, so ``split_join`` joins on one struct of the keys instead: both
inputs are shuffled for the join, and nothing is counted beforehand. Numbering rows of a key needs a window, which
Spark cannot split; ``number_in_parts`` spreads the rows of large keys over buckets, by a rule that holds for all keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, handed_over

# Hexadecimal digits of a hash that choose the bucket of a row within its key: 256 buckets.
BUCKET_DIGITS = 2
# Rows of one key that a single task may sort and number.
LARGE_KEY = 100_000


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hashed: bool = False) -> DataFrame:
    """Equi-join (``inner``, ``left``, ``left_semi``, ``left_anti``) whose left side may be skewed.

    A NULL in any key matches nothing, as in a plain equi-join. The left key sees to that alone: a rule on the right one would become a
    filter on the right input, which then could not be read from a shuffle that the left input shares. With ``hashed`` rows are sorted by a hash
    of the key first: numbers are compared much faster than structs, but rows that lie together then have less in common for compression.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key = F.struct(*keys)
    if not hashed:  # the left key stands in the condition alone, so that no shuffle carries its columns twice
        return left.join(right.withColumn("_offered", key).drop(*keys), F.when(known, key) == F.col("_offered"), how).drop("_offered")
    same = (F.xxhash64("_key") == F.xxhash64("_offered")) & (F.col("_key") == F.col("_offered"))
    return left.withColumn("_key", F.when(known, key)).join(right.withColumn("_offered", key).drop(*keys), same, how).drop("_key", "_offered")


def spread_join(left: DataFrame, right: DataFrame, on: dict[str, str], spread: list[str]) -> DataFrame:
    """Left equi-join, ``on`` left column = right column, whose left side often has no key.

    Rows with a NULL in a key match nothing. A plain join sends them all to one task; here they are dealt out by a hash of ``spread``.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    wanted = F.struct(*on, F.when(known, 0).otherwise(F.xxhash64(*spread)).alias("_spread"), known.alias("_known"))
    offered = F.struct(*[F.col(r).alias(k) for k, r in on.items()], F.lit(0).cast("bigint").alias("_spread"), F.lit(True).alias("_known"))
    return left.withColumn("_wanted", wanted).join(
        right.withColumn("_offered", offered), F.col("_wanted") == F.col("_offered"), "left").drop("_wanted", "_offered")


def without(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple is not in ``right``; both sides may repeat keys."""
    return split_join(left, right.select(*keys).distinct(), keys, "left_anti")


def bucket(order_by: list[str]) -> Column:
    """Bucket of a row within its key: the first digits of the MD5 of its ordering columns as text."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in order_by])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BUCKET_DIGITS), 16, 10).cast("int")


def number_in_parts(df: DataFrame, keys: list[str], order_by: list[str], chunk: int, large: int = LARGE_KEY) -> DataFrame:
    """Add ``part``: the rows of a key in parts of ``chunk``, numbered from 0 without gaps; only the last may hold fewer.

    Rows are taken bucket by bucket (see ``bucket``), in a bucket by ``order_by``. The result depends on
    the rows alone, not on their number or partitions. NULL is a key like others.

    The rows are made once and stored; keys of more than ``large`` rows are found by a count over the stored keys. Without any, one
    shuffle by the keys numbers the rows, and grouping them by keys and part needs no other. The rows of a large key are ranked in a
    task for each bucket, behind the counts of its earlier buckets, at most 256 rows a key. Callers pass only the columns they need.
    """
    rows = handed_over(df.withColumn("_bucket", bucket(order_by)))
    hot = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > large).select(F.struct(*keys).alias("_group")))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_bucket", *order_by))
    if not hot.isEmpty():
        # There is one hot key for every ``large`` rows at most, so both tables are small.
        marked = rows.withColumn("_group", F.struct(*keys)).join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_group", "left")
        earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        before = marked.where("_hot").groupBy("_group", F.col("_bucket").alias("_slice")).agg(F.count("*").alias("_n")).select(
            "_group", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        rows = marked.withColumn("_slice", F.when(F.col("_hot"), F.col("_bucket"))).join(F.broadcast(before), ["_group", "_slice"], "left")
        one = Window.partitionBy(*keys, "_slice").orderBy("_bucket", *order_by)
        place = F.coalesce("_before", F.lit(0)) + F.row_number().over(one)
    return rows.select(*df.columns, F.floor((place - 1) / chunk).cast("bigint").alias("part"))
