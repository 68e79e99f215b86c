"""Reading the yearly register files (S1-S4, S6, S8-S12, S14) and their header catalogue
(A10-A12).

A multi-file CSV read applies one header, by position, to every file, so files whose
headers differ cannot be read together. The catalogue therefore groups files by *header
signature* (separator, encoding, quoted line breaks or not, column names); each signature is
one ``spark.read.csv`` over all of its files, in parallel, with an all-string schema, and the
signatures are put together by column name afterwards.

The catalogue reads the first lines only: a file's separator and header. Whether a quoted cell
holds a line break anywhere (a line with an odd number of quotes), and whether all lines are UTF-8,
takes a look at all of them: one aggregate over the lines, one row per file to the driver, which a
caller who knows that no cell holds one can leave out (``quoted=False``), so that the read proper is the only scan.
Files with such cells are read in splits all the same, and those that are not known to be UTF-8 have
each line decoded by itself, as UTF-8 if it is that and else as Latin-1 (``quoted.py``); the others go to
Spark's own reader.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from airledger import fixed_values as fv
from airledger.functions import text as T
from airledger.functions import values as V
from airledger.operators.tables import fixed_table
from airledger.sources import quoted as Q

EXTRA = "_extra_field"
LONG_ROW = "_fila_larga"
UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
SEPARATORS = ";,\t|"
BOM = "\ufeff"
#: Lines that a header may take, where its names hold line breaks.
HEADER_LINES = 100


@dataclass
class FileInfo:
    path: str
    name: str
    encoding: str
    sep: str
    columns: list[str] = field(default_factory=list)
    error: str | None = None
    multiline: bool = False
    all_utf8: bool = False  # every line is known to be

    @property
    def signature(self) -> tuple:
        return (self.all_utf8, self.sep, self.multiline, tuple(self.columns))


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> list[str]:
    """Data files under ``root`` matching ``glob``, empty ones too, sorted by name. Taken
    from Spark's file listing; no content is read and no job runs."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true").load(root))
    return sorted((unquote(p) for p in listed.inputFiles()), key=lambda p: p.rsplit("/", 1)[-1])


def header_cells(line: str) -> tuple[str, list[str]]:
    """The separator -- of ``SEPARATORS`` the most frequent outside quotes, the first of
    them on a tie -- and the header's names. An empty name or one that is there already gets
    its position, so every column can be told apart."""
    line = line.lstrip(BOM)
    bare = "".join(line.split('"')[::2])
    sep = max(SEPARATORS, key=lambda s: (bare.count(s), -SEPARATORS.index(s)))
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([line], delimiter=sep), [])):
        name = cell.lstrip(BOM).strip()
        names.append(name if name and name not in names else f"{name or '_c'}{i}")
    return sep, names


def _header(spark: SparkSession, path: str) -> bytes | None:
    """The first record's bytes; None if the file has no line. Reads the beginning of the file only."""
    first = Q.text_lines(spark, [path]).where("block = 0").select(F.col("value").cast("binary"))
    lines = [bytes(r[0]) for r in first.limit(1).collect()]
    if lines and lines[0].count(b'"') % 2:
        lines = [bytes(r[0]) for r in first.limit(HEADER_LINES).collect()]
        odd = [line.count(b'"') % 2 for line in lines]
        lines = lines[:next((i + 1 for i in range(1, len(lines)) if sum(odd[:i + 1]) % 2 == 0), len(lines))]
    return b"\n".join(lines).removesuffix(b"\r") if lines else None


def catalogue(spark: SparkSession, paths: list[str], quoted: bool = True) -> list[FileInfo]:
    """S8/S1/A10 input: every file's encoding, separator and header, in ``paths`` order, and, with
    ``quoted``, from one scan of all lines whether cells hold line breaks and whether all lines are
    UTF-8. A file without a line, or whose header cannot be read, has its reason in ``error``."""
    if not paths:
        return []
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    found = {}
    if quoted:
        per_file = Q.text_lines(spark, paths).groupBy("file").agg(
            F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(Q.quotes(F.col("value")) % 2 == 1).alias("multiline"))
        found = {_plain(r["file"]): r for r in per_file.collect()}
    return [_file_info(p, h, found.get(_plain(p))) for p, h in zip(paths, headers, strict=True)]


def _plain(path: str) -> str:
    """One spelling of a path: Spark writes a local one as file:/x, its listing as file:///x."""
    return unquote(path).replace(":///", ":/")


def _file_info(path: str, header: bytes | None, scanned) -> FileInfo:
    name = path.rsplit("/", 1)[-1]
    if not header:
        return FileInfo(path, name, UTF8, ";", [], "empty file" if header is None else "no header")
    text = Q.decoded(header)
    utf8 = scanned["utf8"] if scanned else text.encode() == header
    encoding = UTF8 if utf8 else LATIN1
    try:
        sep, columns = header_cells(text)
    except csv.Error as e:
        return FileInfo(path, name, encoding, ";", [], f"[error] {e}")
    return FileInfo(path, name, encoding, sep, columns, None if columns else "no header", bool(scanned and scanned["multiline"]), bool(scanned and utf8))


def catalogue_frame(spark: SparkSession, infos: list[FileInfo]) -> DataFrame:
    """A10: one row per file: type, encoding, separator, column count, original and
    normalised names joined by ``|``."""
    rows = [(i.name, "csv", i.encoding if not i.error else None, i.sep if not i.error else None,
             len(i.columns) if not i.error else None, i.columns if not i.error else None, i.error) for i in infos]
    df = fixed_table(spark, rows, "archivo string, tipo string, encoding_detectado string, separador string, "
                                  "num_columnas int, _cols array<string>, _err string")
    return df.select(
        "archivo", "tipo", "encoding_detectado", "separador", "num_columnas",
        F.coalesce(F.array_join("_cols", "|"), F.col("_err")).alias("columnas_original"),
        F.coalesce(F.array_join(F.transform("_cols", T.snake_name), "|"), F.lit("")).alias("columnas_normalizadas"),
    )


def header_names(catalogue_df: DataFrame) -> DataFrame:
    """(file, original name, normalised name) for every header cell of the readable files."""
    ok = catalogue_df.where(F.col("num_columnas").isNotNull())
    cols = F.split(F.col("columnas_original"), r"\|")
    return ok.select("archivo", F.explode(cols).alias("columna_original")).select(
        "archivo", "columna_original", T.snake_name(F.col("columna_original")).alias("columna_normalizada"))


def header_map(catalogue_df: DataFrame) -> DataFrame:
    """Original -> normalised name, occurrences and distinct files."""
    names = header_names(catalogue_df)
    return (names.groupBy("columna_original", "columna_normalizada")
            .agg(F.count(F.lit(1)).cast("long").alias("apariciones"),
                 F.count_distinct("archivo").cast("long").alias("archivos_distintos"))
            .orderBy("columna_normalizada", "columna_original"))


def header_vocabulary(catalogue_df: DataFrame, examples: int = 5) -> DataFrame:
    """Per normalised name, number of spellings, the ``examples`` most frequent
    spellings (ties by name) and the files that have it."""
    names = header_names(catalogue_df)
    per_variant = names.groupBy("columna_normalizada", "columna_original").agg(F.count(F.lit(1)).alias("n"))
    files = names.groupBy("columna_normalizada").agg(F.count_distinct("archivo").cast("long").alias("archivos_con_esta_columna"))
    of_name = Window.partitionBy("columna_normalizada")
    ranked = (per_variant.withColumn("_rank", F.row_number().over(of_name.orderBy(F.col("n").desc(), "columna_original")))
              .withColumn("variantes_detectadas", F.count(F.lit(1)).over(of_name).cast("long")).where(F.col("_rank") <= examples))
    out = ranked.groupBy("columna_normalizada", "variantes_detectadas").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "columna_original"))), lambda s: s["columna_original"]), " | ")
        .alias("ejemplos_variantes"))
    return out.join(files, "columna_normalizada").orderBy("columna_normalizada")


def read_signature(spark: SparkSession, infos: list[FileInfo], drop_long_rows: bool = True) -> DataFrame:
    """One parallel read, in splits, of every file sharing a header signature. All columns are
    strings; quotes are doubled inside quoted cells and a backslash is plain text; short rows
    are padded with NULL. The schema carries one sentinel column past the header: a row that
    fills it has more fields than the header and is dropped, as a reader that skips bad lines
    does, or (``drop_long_rows=False``) marked in ``_fila_larga`` to be counted. Adds the source
    file name, path and block start for file-order numbering."""
    info = infos[0]
    names = [*info.columns, EXTRA]
    paths = [i.path for i in infos]
    if info.multiline or not info.all_utf8:
        df = Q.parsed(Q.logical_lines(spark, paths, info.multiline), names, info.sep)
        place = [F.url_decode(F.element_at(F.split("file", "/"), -1)).alias("_file_name"), F.col("file").alias("_file_path"), F.col("block").alias("_file_block")]
        df = df.select(*[F.col(f"`{n}`") for n in names], *place)
    else:
        df = (spark.read.schema(StructType([StructField(c, StringType()) for c in names]))
              .option("header", True).option("sep", info.sep).option("encoding", UTF8)
              .option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", True).csv(paths))
        df = df.select("*", F.col("_metadata.file_name").alias("_file_name"), F.col("_metadata.file_path").alias("_file_path"),
                       F.col("_metadata.file_block_start").alias("_file_block"))
    if drop_long_rows:
        return df.where(F.col(EXTRA).isNull()).drop(EXTRA)
    return df.withColumn(LONG_ROW, F.col(EXTRA).isNotNull()).drop(EXTRA)


def group_by_signature(infos: list[FileInfo]) -> list[list[FileInfo]]:
    groups: dict[tuple, list[FileInfo]] = {}
    for i in infos:
        if not i.error:
            groups.setdefault(i.signature, []).append(i)
    return list(groups.values())


def layout_of(name: str) -> str:
    """Register layout by the beginning of the file name."""
    return next((layout for start, layout in fv.LAYOUT_PREFIXES if name.lower().startswith(start)), fv.DEFAULT_LAYOUT)


def read_table(spark: SparkSession, path: str, sep: str | None = None, places: bool = False) -> DataFrame:
    """Plain all-string CSV files with one header (empty cells read as NULL), quoted as in
    ``read_signature``; quoted cells may hold line breaks. With ``places`` their ``_file_path`` and ``_file_block`` stay."""
    infos = catalogue(spark, list_files(spark, path, "*"))
    bad = [f"{i.name}: {i.error}" for i in infos if i.error]
    if bad or not infos:
        raise ValueError(f"not read: {bad or path}")
    for i in infos:
        if sep is not None:
            i.sep = sep
    frames = [read_signature(spark, g).drop("_file_name", *([] if places else ["_file_path", "_file_block"])) for g in group_by_signature(infos)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_activity_codes(spark: SparkSession, path: str) -> DataFrame:
    """S12 source: activity-code dimension files (``codigo, descripcion[, fuente]``) with their
    row order kept for last-wins de-duplication: by file path, then block, then row."""
    df = read_table(spark, path, places=True)
    place = F.struct(F.col("_file_path").alias("file"), F.col("_file_block").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.withColumn("_pos", place).drop("_file_path", "_file_block")


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """S11 source: municipality centres ``comuna, latitud, longitud``."""
    return read_table(spark, path)


def year_of_file(name_col: str = "_file_name"):
    """S9 (last four-digit run of the file name) as an int column."""
    return V.year_from_name_last(F.col(name_col)).try_cast("int")
