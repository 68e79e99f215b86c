"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a session in one JVM (tests, benches) may leave it unset and gets a scratch folder;
    on a cluster an unset folder is an error, since a local one is not seen by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from the files, so
    a lost executor costs a read and nothing is computed twice."""
    path = f"{shared_dir(df.sparkSession)}/{what}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Kept:
    """An input of ``map_texts`` that is one of its kept columns, so it travels once; ``utf8``:
    its text's UTF-8 bytes, null as no bytes."""

    name: str
    utf8: bool = False


def map_texts(df: DataFrame, inputs: Sequence[Column | Kept], outputs: Sequence[T.StructField],
              make: Callable[[], Callable], keep: Sequence[str] | None = None, group: int = 0) -> DataFrame:
    """Columns ``keep`` (all by default) untouched, then ``outputs``: ``make()`` is called once
    a task and returns a function from the values of ``inputs`` in a row to a tuple of outputs;
    with ``group``, from a list of up to so many such tuples to the list of outputs.

    Rows are taken one (or a group) at a time from Arrow batches of BATCH_BYTES, so a task holds
    one batch. Whatever columns ``df`` has, other inputs travel under positions, so names cannot
    clash.
    """
    small_batches(df.sparkSession)
    names = list(df.columns if keep is None else keep)
    extra = [c for c in inputs if not isinstance(c, Kept)]
    src = df.select(*[df[c] for c in names], *[c.alias(f"__in{i}") for i, c in enumerate(extra)])
    n, places, at = len(names), [], iter(range(len(names), len(names) + len(extra)))
    for c in inputs:
        places.append((names.index(c.name), c.utf8) if isinstance(c, Kept) else (next(at), False))
    schema = T.StructType([*src.schema.fields[:n], *outputs])
    out_types = to_arrow_schema(T.StructType(list(outputs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            cols = [(batch.column(i).cast(pa.binary()).fill_null(b"") if utf8 else batch.column(i)) for i, utf8 in places]
            if group:
                rows = [r for at in range(0, batch.num_rows, group)
                        for r in f([tuple(c[i].as_py() for c in cols) for i in range(at, min(at + group, batch.num_rows))])]
            else:
                rows = [f(*(c[i].as_py() for c in cols)) for i in range(batch.num_rows)]
            made = [pa.array([r[i] for r in rows], type=t.type) for i, t in enumerate(out_types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=[*batch.schema.names[:n], *out_types.names])

    return src.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches end at BATCH_BYTES instead of Spark's 64 MB, so that long texts make no large
    batches: a worker holds a batch, what it makes of it, and Spark a copy of each. A limit that
    the session has set itself stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == f"{64 << 20}b":  # the default, as Spark writes it
        spark.conf.set(name, str(BATCH_BYTES))


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; null as no bytes."""
    return F.coalesce(text, F.lit("")).cast("binary")
