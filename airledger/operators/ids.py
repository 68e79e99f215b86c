"""Deterministic row numbering (W2) that never puts a whole group into one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` moves every row of a group to a
single task; with one year (or one file) holding a third of the data that task is the
job. Instead the order of all rows, by group and then by the order keys, is cut into slices of
about the same number of rows: rows are numbered inside each (group, slice), and a running sum over the
table of slice counts gives each slice its offset.

The borders of the slices are taken from a sample of the full keys (``with_slice``). Which keys are in the
sample depends on their hash alone, so the borders are the same however often, where or with which
columns Spark evaluates them, and a row's slice is a function of that row.

The order keys must be a total order (unique per group); ties would make a rerun after
executor loss free to number tied rows differently. Rows of one full key share a slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
#: Keys in the sample, about, and slices at most: 64 sampled keys to a slice, so a slice is hardly
#: ever half as large again as the mean. STEP: borders that are searched at once.
SAMPLED, SLICES, STEP = 1 << 14, 256, 16


def with_slice(df: DataFrame, keys: list[str], out: str = "_slice") -> DataFrame:
    """``df`` with each row's place among SLICES slices of about equal size in the order of ``keys`` (nulls first): the
    number of borders that are not above its keys. The borders come from a scalar subquery over the distinct keys
    whose hash falls into a share of SAMPLED / distinct keys; what is collected is about SAMPLED keys, in arrays."""
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    distinct = df.agg(F.approx_count_distinct(F.xxhash64(key))).scalar()
    share = F.greatest(F.lit(1).cast("long"), F.floor(distinct / SAMPLED))
    picked = df.select(key.alias("key")).where(F.pmod(F.xxhash64("key"), share) == 0)
    keys_in_order = picked.agg(F.array_sort(F.collect_set("key")).alias("all"))
    wanted = F.least(F.size("all"), F.lit(SLICES - 1))  # borders
    border = F.transform(F.sequence(F.lit(1), wanted), lambda i: F.get("all", F.floor(i * F.size("all") / (wanted + 1)).cast("int")))
    borders = keys_in_order.select(F.when(wanted > 0, border).otherwise(F.slice("all", 1, 0))).scalar()

    all_, own = F.col("_borders"), F.col("_own_key")
    coarse = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / STEP).cast("int")), lambda i: F.get(all_, i * STEP))
    first = F.greatest(F.lit(0), F.size(F.filter(coarse, lambda b: b <= own)) - 1) * STEP
    staged = df.withColumns({"_borders": borders, "_own_key": key}).withColumn("_first", first)
    place = F.when(F.size(all_) == 0, 0).otherwise(F.col("_first") + F.size(F.filter(F.slice(all_, F.col("_first") + 1, STEP), lambda b: b <= own)))
    return staged.withColumn(out, place).drop("_borders", "_own_key", "_first")


def join_same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on null-safe equality of ``keys``, which stay once."""
    renamed = right.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_right_{i}")) for i, k in enumerate(keys)])
    return left.join(renamed, on).drop(*[f"_right_{i}" for i in range(len(keys))])


def sequence_in_group(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "seq") -> DataFrame:
    """1-based position of each row inside its group, in ascending ``order_cols`` order (NULLs
    first). Rows with a NULL group are a group of their own."""
    keys = [*group_cols, "_slice"]
    sliced = with_slice(df, [*group_cols, *order_cols])
    before = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
               .select(*keys, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")))
    numbered = sliced.withColumn("_in", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)))
    joined = join_same_keys(numbered, offsets, keys)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_in")).cast("long").alias(out))


def sequence_in_file(df: DataFrame, out: str = "seq") -> DataFrame:
    """1-based position of each row inside its source file, in file order, for text
    sources. Splits of one file are ordered by ``file_block_start``; rows inside a split
    keep read order (``monotonically_increasing_id`` is consecutive within a split because
    a split is read contiguously inside one partition). No shuffle of the rows: only the
    per-split counts are aggregated."""
    staged = (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_blk", F.col("_metadata.file_block_start"))
              .withColumn("_mid", F.monotonically_increasing_id()))
    return _offsets_by_split(staged, out)


def sequence_in_file_cols(df: DataFrame, file_col: str, block_col: str, out: str = "seq") -> DataFrame:
    """As ``sequence_in_file`` when the file path and block start were captured earlier."""
    staged = (df.withColumn("_file", F.col(file_col)).withColumn("_blk", F.col(block_col))
              .withColumn("_mid", F.monotonically_increasing_id()))
    return _offsets_by_split(staged, out)


def _offsets_by_split(staged: DataFrame, out: str) -> DataFrame:
    splits = staged.groupBy("_file", "_blk").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = Window.partitionBy("_file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    joined = staged.join(offsets, on=["_file", "_blk"], how="inner")
    return (joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long"))
            .drop("_file", "_blk", "_mid", "_first", "_off"))


def format_id(year: Column, seq: Column) -> Column:
    """Year label followed by the sequence padded to nine digits (longer sequences keep
    all their digits; ``lpad`` would cut them)."""
    return F.format_string("%s%09d", year.cast("string"), seq)


def sequence_across_files(df: DataFrame, group_col: str, file_order_col: str, file_col: str = "_file_path",
                          block_col: str = "_file_block", out: str = "seq") -> DataFrame:
    """1-based position inside ``group_col`` when its files are read one after another in
    ``file_order_col`` order (an era table is its years' files concatenated). Must run on
    rows still in scan order (before any shuffle); only per-split counts are aggregated."""
    staged = df.withColumn("_mid", F.monotonically_increasing_id())
    keys = [group_col, file_order_col, file_col, block_col]
    splits = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = (Window.partitionBy(group_col).orderBy(file_order_col, file_col, block_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    joined = staged.join(offsets, on=keys, how="inner")
    return (joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long"))
            .drop("_mid", "_first", "_off"))
