"""Delimited text whose quoted cells hold line breaks, read in parallel splits.

A task that starts in the middle of a file cannot tell whether it starts inside quotes. But
whether it does is the parity of the quotes before it, so:

1. one aggregate over the lines gives the parity of every split's quotes;
2. the exclusive running sum of the parities over a file's splits, modulo two, gives each split
   its state at the start (one row per split, whatever the file's size);
3. every split joins its lines into records, starting from its state. A record that ends in the split
   it began in is complete. Otherwise its pieces -- the end of one split, whole splits in
   between, the beginning of the last -- are put together by file and number of the record, at
   most two pieces a split;
4. the records go through the built-in ``from_csv``.

Lines end at a line feed; a carriage return before it goes with it at the end of a record and stays inside a
cell. Each line is decoded by itself: as UTF-8 if it is that, else as Latin-1, which takes any byte.
A quote that is never closed takes the rest of its file into its record, as any reader of quoted
cells has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits whose states may be broadcast to the lines; beyond it the join shuffles.
BROADCAST_SPLITS = 500_000


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, value): the lines' bytes; block is the start of the split that read them."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))


def quotes(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether the split starts inside quotes."""
    parity = lines.groupBy("file", "block").agg((F.sum(quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


_PIECES = "file string, block long, row long, part string, value string"
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def decoded(line: bytes) -> str:
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split in order (each line, where the state is null); those that do not begin or end in it as pieces:
    ``head``, ``middle`` or ``tail``."""
    place, row, open_, began, held = None, 0, False, False, []
    out: list[tuple] = []

    def left() -> None:
        """What the split that ends here leaves open."""
        if held:
            out.append((*place, row, "head" if began else "middle", "\n".join(held)))
            held.clear()

    for batch in batches:
        for file, block, inside, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != place:
                left()
                place, row, open_ = (file, block), 0, bool(inside)
            if not held:
                began = not open_
            held.append(decoded(value))
            if inside is not None and value.count(b'"') % 2:
                open_ = not open_
            if not open_:
                out.append((file, block, row, "record" if began else "tail", "\n".join(held)))
                held.clear()
                row += 1
        yield _batch(out)
        out.clear()
    left()
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(_TYPES)], names=["file", "block", "row", "part", "value"])


def logical_lines(spark: SparkSession, paths: list[str], quoted: bool = True) -> DataFrame:
    """(file, block, first, value): the records of the files, ``first`` being a file's first one.
    Without ``quoted`` each line is a record, and the files are read once. A record over several splits gets a block of its own between the splits that it ends and begins, so
    that blocks and, in a block, rows in the order they are read give the order of the file."""
    lines = text_lines(spark, paths)
    if not quoted:
        pieces = lines.select("file", "block", F.lit(None).cast("boolean"), F.col("value").cast("binary")).mapInArrow(_joined, _PIECES)
        return pieces.select("file", "block", ((F.col("block") == 0) & (F.col("row") == 0)).alias("first"), "value")
    states = split_states(lines)
    few = sum(-(-n // (1 << 20)) for n in _sizes(spark, paths)) <= BROADCAST_SPLITS  # splits are of 1 MB at least
    with_state = lines.join(F.broadcast(states) if few else states, ["file", "block"])
    pieces = with_state.select("file", "block", "inside", F.col("value").cast("binary").alias("value")).mapInArrow(_joined, _PIECES)
    records = pieces.where("part = 'record'").select("file", "block", ((F.col("block") == 0) & (F.col("row") == 0)).alias("first"), "value")
    upto = Window.partitionBy("file").orderBy("block", "row")
    numbered = pieces.where("part <> 'record'").withColumn("record", F.sum(F.when(F.col("part") == "head", 1).otherwise(0)).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    long = numbered.groupBy("file", "record").agg(parts.alias("parts"), F.max("block").alias("last"), F.bool_or(F.col("part") == "tail").alias("ended"))
    start = F.element_at("parts", 1)
    long = long.select("file", F.when(F.col("ended"), F.col("last") - 1).otherwise(F.col("last") + 1).alias("block"),
                       ((start["block"] == 0) & (start["row"] == 0)).alias("first"), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return records.unionByName(long)


def _sizes(spark: SparkSession, paths: list[str]) -> list[int]:
    """Bytes of each file, from the file system's listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [p.getFileSystem(conf).getFileStatus(p).getLen() for p in at]


def parsed(records: DataFrame, names: list[str], sep: str) -> DataFrame:
    """The records' cells as the columns ``names`` (strings), with file and block. Blank records and
    files' first ones (the headers) are left out; empty cells are null, quotes are doubled in quoted cells."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    rows = records.where(~F.col("first")).select("file", "block", F.regexp_replace("value", r"\r$", "").alias("value")).where(F.rlike("value", F.lit(r"[^\x00-\x20]")))
    cells = rows.select("file", "block", F.from_csv("value", schema, options).alias("cells"))
    return cells.select("file", "block", *[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)])
