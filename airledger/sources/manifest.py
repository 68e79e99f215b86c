"""Totals kept up to date when files are replaced (S8, U1, decision 3).

The state folder holds, per version, a manifest -- one row per file: path, length, time of change,
digest of its lines -- and each file's contribution to the totals, one row per file and key. A refresh

1. lists the files; those whose length and time are as in the manifest are not opened;
2. takes the digest of the others; one whose lines are the same is taken as it is;
3. reads what is new or changed, and only that; the contributions of changed and vanished files go, those of
   the read ones come;
4. writes the differences as rows of (keys, value): what came with its sign, what went with the
   opposite one. A stream that sums the folder of differences (``streaming.totals``) thereby takes back what a
   replaced file had added.

A version counts once its differences are written, which is last; an attempt that failed before that is
written again. Sums are of decimals, so a value that is taken back leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.operators.tables import fixed_table
from airledger.sources import quoted as Q

MANIFEST = "file string, length long, changed string, digest string"


@dataclass
class Refresh:
    version: int
    read: list[str]
    unchanged: list[str]
    gone: list[str]


def digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Per file a digest of its lines, whatever their order: their number, and the sum and exclusive or
    of their hashes. One aggregate over the lines, one row per file to the driver."""
    if not paths:
        return {}
    lines = Q.text_lines(spark, paths).select("file", F.xxhash64(F.col("value").cast("binary")).alias("h"))
    rows = lines.groupBy("file").agg(F.concat_ws("-", F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(20,0)")), F.bit_xor("h")).alias("digest")).collect()
    found = {_plain(r["file"]): r["digest"] for r in rows}
    return {p: found.get(_plain(p), "0") for p in paths}


def _plain(path: str) -> str:
    from urllib.parse import unquote
    return unquote(path).replace(":///", ":/")


def listing(spark: SparkSession, folder: str, glob: str = "*.csv") -> dict[str, tuple[int, str]]:
    """Path -> (length, time of change) of the files; their contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
             .select("path", "length", F.col("modificationTime").cast("string").alias("changed")))
    return {r["path"]: (r["length"], r["changed"]) for r in files.collect()}


def versions(spark: SparkSession, state: str) -> list[int]:
    """Versions whose differences are written whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/differences")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/differences/version=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _manifest(spark: SparkSession, state: str, version: int) -> dict[str, tuple[int, str, str]]:
    if not version:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{state}/manifest/version={version}").collect()  # a row per file
    return {r["file"]: (r["length"], r["changed"], r["digest"]) for r in rows}


def refresh(spark: SparkSession, folder: str, state: str, contribute: Callable[[list[str]], DataFrame], keys: list[str], value: str,
            glob: str = "*.csv") -> Refresh:
    """Brings the state up to the files in ``folder``. ``contribute`` gives, for the paths that have to be read,
    rows of ``file`` (as Spark writes it), ``keys`` and ``value`` (a decimal), a row per file and key or many."""
    last = max(versions(spark, state), default=0)
    before, now = _manifest(spark, state, last), listing(spark, folder, glob)
    touched = [p for p, at in now.items() if p not in before or before[p][:2] != at]
    lines = digests(spark, touched)
    read = sorted(p for p in touched if p not in before or before[p][2] != lines[p])
    gone = sorted(set(before) - set(now))
    version = last + 1

    manifest = [(p, *at, lines.get(p) or before[p][2]) for p, at in now.items()]
    fixed_table(spark, manifest, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{state}/manifest/version={version}")
    # files are joined by one spelling of their paths, as listings and readers differ
    plain = F.regexp_replace(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))), ":///", ":/")
    came = None
    if read:
        came = contribute(read).select(plain.alias("file"), *keys, F.col(value).alias("value")).groupBy("file", *keys).agg(F.sum("value").cast("decimal(38,10)").alias("value"))
    kept = went = None
    if last:
        old = spark.read.parquet(f"{state}/contributions/version={last}")
        lost = fixed_table(spark, [(_plain(p),) for p in [*(p for p in read if p in before), *gone]], "file string")
        kept, went = old.join(lost, "file", "left_anti"), old.join(lost, "file", "left_semi")
    whole = came if kept is None else kept if came is None else kept.unionByName(came)
    if whole is None:
        whole = contribute([]).select(plain.alias("file"), *keys, F.col(value).cast("decimal(38,10)").alias("value")).limit(0)
    whole.write.mode("overwrite").parquet(f"{state}/contributions/version={version}")
    own = spark.read.parquet(f"{state}/contributions/version={version}")
    added = fixed_table(spark, [(_plain(p),) for p in read], "file string")
    signed = own.join(added, "file", "left_semi").select(*keys, "value")
    if went is not None:
        signed = signed.unionByName(went.select(*keys, (-F.col("value")).alias("value")))
    (signed.groupBy(*keys).agg(F.sum("value").cast("decimal(38,10)").alias("value")).where("value <> 0 or value is null")
     .write.mode("overwrite").parquet(f"{state}/differences/version={version}"))
    return Refresh(version, read, sorted(set(now) - set(read)), gone)


def totals(spark: SparkSession, state: str, keys: list[str], out: str = "emision") -> DataFrame:
    """The totals of the last version, from the files' contributions."""
    last = max(versions(spark, state))
    return spark.read.parquet(f"{state}/contributions/version={last}").groupBy(*keys).agg(F.sum("value").alias(out))
