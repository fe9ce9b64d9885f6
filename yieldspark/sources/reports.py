"""Report scans: a drop directory of exported station reports (A1-A3).

Reports arrive as CSV, Parquet or workbook files with human headers
("Workstation Name", "History Station End Time", ...). Every cell is read as
text and keeps its file of origin and a per-file row ordinal, so the ingest
job can apply first-row-wins rules and file-scoped quarantine later.

Columns are bound by name: files with the same header are one Spark read, and
the reads are united by normalised column name, so files whose columns stand
in another order, are missing or are added can lie in one folder.

A file that cannot be read does not stop the others (A14). The headers of all
CSV files come from one job; a file without a line, or whose first line is no
text, is an error, and a row that does not fit its header is marked. Parquet files
are read with merged schemas and ``ignoreCorruptFiles``, and then reconciled:
their footers say how many rows each file holds, so a file that is missing or
comes up short is found and reported instead of being left out in silence.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_COL = "source_file"
ROW_COL = "row_ordinal"
BAD_COL = "read_error"
_CORRUPT = "__corrupt"
_NO_TEXT = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffd]")  # control characters, or bytes that are no UTF-8
WORKBOOK = ".xlsx"


def normalize_header(name: str, strict: bool = True) -> str:
    """lower case, space/hyphen -> ``_``; strict mode also drops what is no letter, digit or ``_`` (A3)."""
    out = name.lower().replace(" ", "_").replace("-", "_")
    if strict:
        out = re.sub(r"[^\w]", "", out)
    return out


def unique_names(names: Sequence[str]) -> list[str]:
    """The first of several equal names keeps it, later ones get a number."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}__{seen[n]}")
    return out


def normalize_headers(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rename columns on the driver (metadata only, no data moves)."""
    return df.toDF(*unique_names([normalize_header(c, strict) for c in df.columns]))


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> list[str]:
    """Files under a drop directory (names only; contents are not read)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return sorted(r["path"] for r in reader.load(path).select("path").collect())


def _kind(file: str) -> str:
    name = file.lower()
    return "xlsx" if name.endswith(WORKBOOK) else "parquet" if name.endswith(".parquet") else "csv"


class Scan(NamedTuple):
    """What the report files of a batch hold.

    ``rows``: text cells, file, ordinal and ``read_error`` (NULL for a good row). ``errors``: file and reason of files that
    cannot be read. ``expected``: file and number of rows of files that say so themselves; one with fewer rows in ``rows``
    is damaged. Each is ``None`` where there are none.
    """

    rows: DataFrame | None
    errors: DataFrame | None
    expected: DataFrame | None


def _local(path: str) -> str:
    """A path as both the file listing and the row metadata spell it."""
    return re.sub(r"^file:/+", "/", unquote(path))


def _cells(df: DataFrame, columns: dict[str, list[str]], bad: Column) -> DataFrame:
    """Every cell as text under its normalised name, plus file, ordinal and read error.

    ``columns``: normalised name -> columns of ``df``; the first that is not NULL counts.
    """
    meta = F.col("_metadata")
    order = F.struct(meta.getField("file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return df.select(*[F.coalesce(*[F.col(f"`{c}`").cast("string") for c in cs]).alias(n) for n, cs in columns.items()],
                     meta.getField("file_path").alias(FILE_COL), order.alias(ROW_COL), bad.alias(BAD_COL))


def _csv_headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """File -> first line that is not blank, of all files in one job."""
    meta = F.col("_metadata")
    lines = spark.read.option("ignoreCorruptFiles", "true").text(files).where(F.trim("value") != "").select(
        meta.getField("file_path").alias("file"), "value",
        F.struct(meta.getField("file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"))
    return {_local(r["file"]): r["value"] for r in lines.groupBy("file").agg(F.min_by("value", "at").alias("value")).collect()}


def _scan_csv(spark: SparkSession, files: list[str]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    headers, groups, errors = _csv_headers(spark, files), {}, []
    for f in files:
        line = headers.get(_local(f))
        cells = next(csv.reader([line.replace("\0", " ")]), []) if line else []
        if not cells:
            errors.append((f, "unreadable: no header"))
        elif _NO_TEXT.search(line):
            errors.append((f, "unreadable: no text"))
        else:
            groups.setdefault(tuple(cells), []).append(f)
    parts = []
    for cells, fs in groups.items():
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(cells))] + [
            T.StructField(_CORRUPT, T.StringType())])
        df = (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", _CORRUPT).option("ignoreCorruptFiles", "true").csv(fs))
        columns = {n: [f"c{i}"] for i, n in enumerate(unique_names([normalize_header(c) for c in cells]))}
        # Spark does not read the corrupt-record column alone, so the condition names a cell as well.
        read = F.length(F.concat_ws("", "c0", _CORRUPT)) >= 0
        parts.append(_cells(df, columns, F.when(F.col(_CORRUPT).isNotNull() & read, F.lit("malformed row"))))
    return parts, errors


def _scan_parquet(spark: SparkSession, files: list[str]) -> tuple[list[DataFrame], list[tuple[str, str]], DataFrame | None]:
    reader = spark.read.option("ignoreCorruptFiles", "true")
    broken: dict[str, str] = {}

    def schema_of(f: str) -> T.StructType | None:
        try:
            return spark.read.parquet(f).schema
        except (PySparkException, Py4JJavaError):
            broken[f] = "unreadable: no Parquet file"
            return None

    try:  # one job reads all footers
        tables = [reader.option("mergeSchema", "true").parquet(*files)]
    except (PySparkException, Py4JJavaError):  # no file is readable, or a column has several types: a read per schema
        groups: dict[str, list[str]] = {}
        schemas = {}
        for f in files:
            if (schema := schema_of(f)) is not None:
                schemas[schema.json()] = schema
                groups.setdefault(schema.json(), []).append(f)
        tables = [reader.schema(schemas[k]).parquet(*fs) for k, fs in groups.items()]
    expected = _union([t.groupBy(F.col("_metadata.file_path").alias(FILE_COL)).agg(F.count(F.lit(1)).alias("n"))
                       for t in tables])  # from the footers; no column is read
    if expected is not None:
        held = expected.collect()  # a row per file of the batch
        expected = spark.createDataFrame(held, expected.schema) if held else None
        for f in sorted({*files} - {*broken}, key=str):
            if _local(f) not in {_local(r[FILE_COL]) for r in held}:
                schema_of(f)  # without rows: empty, or broken
    parts = []
    for t in tables:
        columns: dict[str, list[str]] = {}
        for c in t.columns:  # files may spell one column in several ways
            columns.setdefault(normalize_header(c), []).append(c)
        parts.append(_cells(t, columns, F.lit(None).cast("string")))
    return parts, sorted(broken.items()), expected


def scan_files(spark: SparkSession, files: Sequence[str], names: Sequence[str] = ()) -> Scan:
    """Report files of any kind, by file extension.

    ``names``: the columns taken from workbooks. The ordinal is (split start offset, increasing id) inside a file, which
    keeps file order across the splits of one large file without forcing the file into a single task.
    """
    kinds: dict[str, list[str]] = {}
    for f in files:
        kinds.setdefault(_kind(f), []).append(f)
    parts: list[DataFrame] = []
    bad: list[tuple[str, str]] = []
    errors, expected = [], None
    if "csv" in kinds:
        parts, bad = _scan_csv(spark, kinds["csv"])
    if "parquet" in kinds:
        more, broken, expected = _scan_parquet(spark, kinds["parquet"])
        parts, bad = parts + more, bad + broken
    if bad:
        errors.append(spark.createDataFrame(bad, f"{FILE_COL} string, reason string"))
    if "xlsx" in kinds:
        from . import workbook
        cells = workbook.scan_workbooks(spark, kinds["xlsx"])
        rows = workbook.cells_to_columns(cells.where("error is null"), names)
        order = F.struct(F.lit(0).cast("long").alias("block"), F.col(ROW_COL).alias("n"))
        parts.append(rows.withColumn(ROW_COL, order).withColumn(BAD_COL, F.lit(None).cast("string")))
        errors.append(cells.where("error is not null").select(FILE_COL, F.col("error").alias("reason")))
    return Scan(_union(parts), _union(errors), expected)


def short_files(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """source_file, reason of files with fewer rows than they should hold: a row per file."""
    got = rows.groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("got"))
    got = expected.join(got, FILE_COL, "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return got.where("got < n").select(FILE_COL, F.format_string("unreadable: %d of %d rows", "got", "n").alias("reason"))


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def scan_reports(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
                 names: Sequence[str] = ()) -> DataFrame | None:
    """All readable report files under ``path`` as text columns plus file and row ordinal (A1, A2)."""
    return scan_files(spark, list_files(spark, path, glob, recursive), names).rows
