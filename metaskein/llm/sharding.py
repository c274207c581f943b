"""Sharding by extendible hashing: a directory over hash-prefix bits in which only oversized buckets split.

A bucket is a prefix of the hash. A bucket whose rows exceed the byte limit splits on the next bit; its halves are
judged anew, so neighbours may differ in depth. Sizes are summed for eight more bits at a time: one pass over (hash,
bytes) settles every bucket that fits within the next eight splits, and only what is still too large goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import stored

#: Bits of the hash: no bucket splits further.
MAX_DEPTH = 48
#: Bits looked at in one pass; a bucket is judged at each of them.
STEP = 8


def hash_bits(id_col: Column, text_col: Column) -> Column:
    """The first 48 bits of the MD5 of id and text: rows that share an id are spread by their text."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text_col.cast("string"), F.lit(""))).cast("binary")), 1, 12), 16, 10).cast("long")


def prefix(bits: Column, depth: int | Column) -> Column:
    return F.expr(f"shiftright(bits, {MAX_DEPTH - depth})") if isinstance(depth, int) else F.call_function("shiftright", bits, (MAX_DEPTH - depth).cast("int"))


def _settled(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (part, bits, n_bytes, …) with the bucket of their part that they end up in: depth, bucket, bytes, rows."""
    out: DataFrame | None = None
    open_rows, depth = rows, 0
    while True:
        last = min(MAX_DEPTH, depth + STEP)
        cells = stored(open_rows.groupBy("part", prefix(F.col("bits"), last).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))
        levels = cells.select("*", F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth"))
        at = F.call_function("shiftright", "cell", (F.lit(last) - F.col("depth")).cast("int"))
        sizes = levels.groupBy("part", "depth", at.alias("bucket")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        done = sizes.where((F.col("bytes") <= limit) | ((F.col("depth") == last) & F.lit(last == MAX_DEPTH)))
        # The shortest prefix that fits; longer ones below it are not buckets.
        leaf = levels.select("part", "cell", "depth", at.alias("bucket")).join(done, ["part", "depth", "bucket"]) \
            .groupBy("part", "cell").agg(F.min(F.struct("depth", "bucket", "bytes", "rows")).alias("leaf"))
        leaf = stored(cells.select("part", "cell").join(leaf, ["part", "cell"], "left").select("part", "cell", "leaf.*"))
        placed = open_rows.withColumn("cell", prefix(F.col("bits"), last)).join(leaf, ["part", "cell"]).drop("cell")
        ready = placed.where("depth is not null")
        out = ready if out is None else out.unionByName(ready)
        if leaf.where("depth is null").isEmpty():
            return out
        open_rows = stored(placed.where("depth is null").select(rows.columns))
        depth = last


def _name(depth: Column, bucket: Column) -> Column:
    return F.when(depth == 0, "").otherwise(F.lpad(F.conv(bucket.cast("string"), 10, 2), depth, F.lit("0")))


def shards(docs: DataFrame, limit: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard of at most ``limit`` bytes of text.

    Returns ``id_col``, ``n_bytes`` long, ``shard`` string (the prefix as bits; empty if all rows fit one shard), ``depth`` int,
    ``shard_bytes`` long, ``shard_rows`` long and ``fits`` boolean. One row per input row; null texts have no bytes. Only a single row
    larger than the limit cannot be parted: its shard does not fit. Rows alike in id and text have one hash; where they exceed
    the limit together, their bucket goes on splitting by a second hash, of the place they were stored at, whose bits follow the first.
    Other columns are ignored. But for which of several equal rows is where, the directory does not depend on the order or number of partitions.

    Shuffles: (hash, bytes) is summed by prefix in each task first, so a pass moves at most 256 sums of an open bucket a
    task. The assignment joins the small table of a pass, on the prefix; nothing wide moves.
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), hash_bits(F.col(id_col), F.col(text_col)).alias("bits"),
                              F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
                              F.monotonically_increasing_id().alias("row"), F.lit(0).cast("long").alias("part")))
    out = _settled(rows, limit).withColumn("shard", _name(F.col("depth"), F.col("bucket")))
    alike = (F.col("bytes") > limit) & (F.col("rows") > 1)
    stuck = stored(out.where(alike).select("id", "n_bytes", "row", F.col("bucket").alias("part"), F.col("shard").alias("stem"), hash_bits(F.col("row"), F.lit("")).alias("bits")))
    result = out.select("id", "n_bytes", "shard", "depth", "bytes", "rows")
    if not stuck.isEmpty():
        again = _settled(stuck, limit).select("id", "n_bytes", F.concat("stem", _name(F.col("depth"), F.col("bucket"))).alias("shard"),
                                              (F.col("depth") + MAX_DEPTH).alias("depth"), "bytes", "rows")
        result = out.where(~alike).select(result.columns).unionByName(again)
    return result.select(F.col("id").alias(id_col), "n_bytes", "shard", "depth", F.col("bytes").alias("shard_bytes"),
                         F.col("rows").alias("shard_rows"), (F.col("bytes") <= limit).alias("fits"))
