"""Source scans (S-01, S-02, S-04, S-05, S-06) and per-file probes (R-05).

A source is every file under ``root/rel_path`` matching a glob; all files are
read by ONE scan (decision D-1: no file overwrites another), and lineage
comes from Spark's hidden ``_metadata`` column, so no Python touches rows.

File names: Spark percent-encodes them in ``_metadata`` and reads a path as a
pattern. Here a name is always the one users see (``raw_name``), and folders and
paths are given to readers literally (``literal``), so names may hold spaces,
percent signs, brackets and braces.

``file_manifest`` is the one table about the files of a source: name, size, rows
and what is wrong. The probe, the load and the check for damage inside a file all
use it; the rows of the good files never need a list of them.
"""

from __future__ import annotations

import csv
import fnmatch
import re
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimkiln.session import ship_package, write_shared

# Defaults of a source row (pattern, sheet) and the fallback pattern.
DEFAULT_PATTERN = "*.xlsx"
DEFAULT_SHEET = "Sheet1"
HEADER_ROWS = 1  # spreadsheet row numbers start after one header row

FILE_NAME = "_file_name"
FILE_PATH = "_file_path"
ROW_NUMBER = "_row_number"


def _blank(v) -> bool:
    return v is None or (isinstance(v, float) and v != v) or str(v).strip() == ""


def source_defaults(pattern, sheet) -> tuple[str, str]:
    """Pattern and sheet of a source row; blank (NULL, NaN, spaces) -> default."""
    return (DEFAULT_PATTERN if _blank(pattern) else str(pattern).strip(),
            DEFAULT_SHEET if _blank(sheet) else str(sheet).strip())


def format_for(pattern: str) -> str:
    """Reader format from the file pattern's extension (``*.xlsx`` is re-aimed, S-02)."""
    ext = pattern.rsplit(".", 1)[-1].lower() if "." in pattern else "parquet"
    return {"csv": "csv", "txt": "csv", "json": "json", "jsonl": "json", "orc": "orc",
            "parquet": "parquet", "xlsx": "xlsx"}.get(ext, "parquet")


def literal(path: str) -> str:
    """``path`` for a reader, which would take brackets, braces and stars as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def raw_name(field: str) -> Column:
    """``_metadata.file_name`` or ``_metadata.file_path`` as users see it, not percent-encoded."""
    c = F.col(f"_metadata.{field}")
    return F.when(F.contains(c, F.lit("%")), F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))).otherwise(c)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the Hadoop file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_files(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """S-01: file names under ``directory`` matching ``pattern`` (driver-side listing).

    Uses the Hadoop file system of the path, so it works on any cluster store.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path) if st.isFile()]
    return sorted(n for n in names if fnmatch.fnmatch(n, pattern))


def resolve_pattern(spark: SparkSession, directory: str, pattern: str) -> str | None:
    """S-01: the pattern if it matches, else the fallback ``*.xlsx``, else None."""
    if list_files(spark, directory, pattern):
        return pattern
    if pattern != DEFAULT_PATTERN and list_files(spark, directory, DEFAULT_PATTERN):
        return DEFAULT_PATTERN
    return None


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_lineage(df: DataFrame, header_rows: int = HEADER_ROWS) -> DataFrame:
    """S-05 + K-08 inputs: file name, path and sheet-style row number per row.

    ``_metadata.row_index`` exists for Parquet scans; the row number is
    ``row_index + header_rows + 1`` (first data row = 2).
    """
    return df.select("*",
                     raw_name("file_name").alias(FILE_NAME),
                     raw_name("file_path").alias(FILE_PATH),
                     (F.col("_metadata.row_index") + header_rows + 1).alias(ROW_NUMBER))


def _splits(tagged: DataFrame) -> DataFrame:
    """(path, block, _first, _before) per file split: first tag, and rows of the file before it.

    One row per split, a bound set by the input size over the split size.
    """
    blocks = tagged.groupBy(FILE_PATH, "_blk").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.partitionBy(FILE_PATH).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(FILE_PATH, "_blk", "_first",
                         F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_before"))


def _tagged(df: DataFrame) -> DataFrame:
    """``df`` with file, split and position in the task, written once to the shared folder.

    Counts of splits and the rows themselves are both read from what was written:
    they agree even if a second scan would cut the files differently (executors
    that join or leave change how files are packed).
    """
    return write_shared(df.select(
        "*", raw_name("file_name").alias(FILE_NAME), raw_name("file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_mid")), "scan")


def with_block_row_numbers(df: DataFrame, header_rows: int = HEADER_ROWS) -> DataFrame:
    """S-05 for formats whose scan gives no ``row_index`` (JSON lines, ORC).

    A file is read as splits; each row carries its split's start offset
    (``_metadata.file_block_start``) and its position inside the task
    (``monotonically_increasing_id``). Row number = rows in earlier splits of
    the file + position in the split + ``header_rows`` + 1.
    """
    tagged = _tagged(df)
    return (tagged.join(_splits(tagged), [FILE_PATH, "_blk"], "inner")
            .withColumn(ROW_NUMBER, F.col("_before") + (F.col("_mid") - F.col("_first"))
                        + header_rows + 1)
            .drop("_blk", "_mid", "_first", "_before"))


def scan_source(spark: SparkSession, directory: str, pattern: str | None = None,
                fmt: str | None = None, schema: StructType | None = None,
                as_text: bool = True, lineage: bool = True,
                options: dict | None = None, sheet: str | None = None,
                columns: list[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """S-02/S-04: read every matching file at once; optionally all columns as text.

    Text is how a spreadsheet source arrives (``dtype=str``); casting happens
    later in ``typed_load``. When no file matches, an empty frame of
    ``schema`` (or no columns) is returned (S-01). ``exclude`` names files
    to leave out (those found unreadable or damaged, R-05): the scan passes over
    what it cannot read, and the rows it did get from such files are dropped.
    """
    pattern, sheet = source_defaults(pattern, sheet)
    found = resolve_pattern(spark, directory, pattern)
    if found is None:
        return empty_frame(spark, schema or StructType([]))
    fmt = fmt or format_for(found)
    options, left_out = dict(options or {}), sorted(set(exclude))
    if fmt == "xlsx":
        from dimkiln.sources.xlsx import read_xlsx
        return _finish(read_xlsx(spark, directory, found, sheet, columns, left_out), as_text)
    if fmt == "csv" and schema is None and not _READER_ONLY & {k.lower() for k in options}:
        return _finish(_scan_csv(spark, directory, found, options, lineage, left_out), as_text)
    reader = spark.read.option("pathGlobFilter", found)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", False)
    if fmt in _COLUMNAR:
        reader = reader.option("ignoreCorruptFiles", bool(left_out))
    if schema is not None and fmt in ("csv", "json"):
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.format(fmt).load(literal(directory))
    if left_out:
        df = df.filter(~raw_name("file_name").isin(left_out))
    if lineage and fmt == "parquet":
        df = with_lineage(df)
    elif lineage and fmt in ("csv", "json", "orc"):
        df = with_block_row_numbers(df, 0 if fmt == "json" else HEADER_ROWS)
    return _finish(df, as_text)


_COLUMNAR = ("parquet", "orc")
# options under which a CSV record is not one line of UTF-8 text
_READER_ONLY = {"multiline", "encoding", "charset", "linesep", "comment"}


def _finish(df: DataFrame, as_text: bool) -> DataFrame:
    return as_text_frame(df) if as_text else df


def header_names(line: str, options: dict) -> list[str]:
    """Column names of a header line: a blank one is ``_c<place>``, repeated ones get their place."""
    sep = next((v for k, v in options.items() if k.lower() in ("sep", "delimiter")), ",")
    quote = next((v for k, v in options.items() if k.lower() == "quote"), '"')
    cells = next(csv.reader([line], delimiter=sep, quotechar=quote), [])
    lowered = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lowered.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _scan_csv(spark: SparkSession, directory: str, pattern: str, options: dict, lineage: bool,
              left_out: list[str]) -> DataFrame:
    """Every CSV file with the columns its own header names (decision D-2), from one scan of lines.

    The lines are written once with file and split; a file's header is its first
    line. Lines are parsed by position, and a value is looked up at the place its
    file's header gives the column, so any number of headers is one plan without
    a list of files; a column that a file lacks is NULL there. Only the distinct
    header lines come to the driver. Blank lines are no records.
    """
    text = spark.read.option("pathGlobFilter", pattern).text(literal(directory))
    lines = _tagged(text.filter(F.length(F.trim(F.translate("value", "\t\r\x0b\x0c", "    "))) > 0))
    if left_out:
        lines = lines.filter(~F.col(FILE_NAME).isin(left_out))
    splits = _splits(lines)
    start = splits.filter("_before = 0").select(FILE_PATH, "_blk", "_first")
    headers = (lines.join(start, [FILE_PATH, "_blk"]).filter(F.col("_mid") == F.col("_first"))
               .select(FILE_PATH, F.col("value").alias("_header")))
    distinct = sorted(r["_header"] for r in headers.select("_header").distinct().collect())
    if not distinct:
        return empty_frame(spark, StructType([]))
    names = {h: header_names(h, options) for h in distinct}
    width = max(len(n) for n in names.values())
    columns = list(dict.fromkeys(c for h in distinct for c in names[h]))
    known = spark.createDataFrame([(h, names[h]) for h in distinct], "_header string, _names array<string>")
    numbered = (lines.join(splits, [FILE_PATH, "_blk"])
                .withColumn("_at", F.col("_before") + F.col("_mid") - F.col("_first")).filter("_at > 0"))
    if len(distinct) > 1:
        numbered = numbered.join(headers.join(known, "_header").select(FILE_PATH, "_names"), FILE_PATH)
    wide = ", ".join(f"c{i} string" for i in range(width))
    parsed = numbered.withColumn("_cells", F.from_csv("value", wide, {**options, "mode": "PERMISSIVE"}))
    if len(distinct) == 1:
        values = [F.col(f"_cells.c{i}").alias(c) for i, c in enumerate(names[distinct[0]])]
    else:
        cells = F.array(*[F.col(f"_cells.c{i}") for i in range(width)])
        place = {c: F.array_position("_names", c).cast("int") for c in columns}
        values = [F.when(place[c] > 0, F.element_at(cells, place[c])).alias(c) for c in columns]
    traces = [FILE_NAME, FILE_PATH, (F.col("_at") + HEADER_ROWS).alias(ROW_NUMBER)] if lineage else []
    return parsed.select(*values, *traces)


# Atomic types whose text form never holds what clean-up changes (no edge or
# repeated whitespace, no backslash): such columns are tagged so clean-up can
# skip an identity step.
_PLAIN_TEXT_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean",
                     "date", "timestamp", "timestamp_ntz")
TYPED_ORIGIN = "dimkiln.typed_origin"


def as_text_frame(df: DataFrame) -> DataFrame:
    """Every column as text (how a spreadsheet row arrives), lineage columns kept.

    Columns converted from a number, date, timestamp or boolean carry their
    original type in the column metadata (``TYPED_ORIGIN``).
    """
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if f.name == ROW_NUMBER or t == "string":
            out.append(F.col(f.name))
        elif t in _PLAIN_TEXT_TYPES or t.startswith("decimal"):
            out.append(F.col(f.name).cast("string").alias(f.name, metadata={TYPED_ORIGIN: t}))
        else:
            out.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """S-06: a stored ODS or dimension table; selecting columns prunes the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def file_manifest(spark: SparkSession, directory: str, pattern: str, fmt: str | None = None,
                  sheet: str = DEFAULT_SHEET) -> DataFrame:
    """S-01, R-05: (File_Path, File_Name, Size, Rows, Error) of every matching file, written once.

    The listing is Spark's own. ``Rows`` is what a Parquet or ORC footer states
    (a scan without columns reads footers only); files without any such row,
    unreadable or empty, are opened one by one on the executors, and so are
    workbooks. ``Error`` says why a file cannot be read. Text formats have no
    structure to look at: their ``Rows`` is NULL.
    """
    ship_package(spark)
    fmt = fmt or format_for(pattern)
    folder = literal(directory)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    # no content is read for a listing
    listed = files.select(F.col("path").alias("File_Path"), raw_name("file_name").alias("File_Name"),
                          F.col("length").alias("Size"))
    if fmt in ("csv", "json"):
        return write_shared(listed.select("*", F.lit(None).cast("long").alias("Rows"),
                                          F.lit(None).cast("string").alias("Error")), "manifest")
    if fmt in _COLUMNAR:
        scan = (spark.read.format(fmt).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True)
                # no column is needed, so no file has to be readable to give a schema
                .schema("_probe string").load(folder))
        rows = scan.groupBy(raw_name("file_name").alias("File_Name")).agg(F.count(F.lit(1)).alias("Rows"))
        listed = write_shared(listed.join(rows, "File_Name", "left"), "manifest-rows")
        # few: broken files and those without rows; their paths come to the driver, as any listing does
        doubtful = [r["File_Path"] for r in listed.filter("Rows IS NULL").select("File_Path").collect()]
        errors = file_errors(spark, doubtful, fmt, sheet)
    else:
        listed = listed.withColumn("Rows", F.lit(None).cast("long"))
        errors = _opened(files, fmt, sheet, False)
    rows = F.when(F.col("Error").isNull(), F.coalesce("Rows", F.lit(0) if fmt in _COLUMNAR else F.lit(None)))
    return write_shared(listed.join(errors, "File_Name", "left").select(
        "File_Path", "File_Name", "Size", rows.cast("long").alias("Rows"), "Error"), "manifest")


def file_errors(spark: SparkSession, paths: list[str], fmt: str, sheet: str = DEFAULT_SHEET,
                whole: bool = False) -> DataFrame:
    """(File_Name, Error) of the files at ``paths`` that do not open or, with ``whole``, do not read to the end."""
    if not paths:
        return spark.createDataFrame([], "File_Name string, Error string")
    return _opened(spark.read.format("binaryFile").load([literal(p) for p in paths]), fmt, sheet, whole)


def _opened(files: DataFrame, fmt: str, sheet: str, whole: bool) -> DataFrame:
    ship_package(files.sparkSession)
    return files.select(raw_name("file_name").alias("File_Name"), "content").mapInPandas(
        lambda batches: _unreadable(batches, fmt, sheet, whole), "File_Name string, Error string")


def damaged_files(manifest: DataFrame, loaded: DataFrame, fmt: str) -> DataFrame:
    """R-05: (File_Name, Error) of files that gave fewer rows than their footers state.

    ``loaded`` is (File_Name, Loaded). A scan that passes over corrupt files stops
    silently where the damage is; the missing rows show in the counts. Each such
    file is then read to its end on an executor for the error. A file that reads
    well there was cut short by something else, a store that failed for a
    moment: that fails the load, so that it is repeated.
    """
    spark = manifest.sparkSession
    short = (manifest.filter("Error IS NULL AND Rows IS NOT NULL").join(loaded, "File_Name", "left")
             .filter(F.coalesce("Loaded", F.lit(0)) < F.col("Rows")).select("File_Path", "File_Name"))
    paths = {r["File_Name"]: r["File_Path"] for r in short.collect()}
    errors = write_shared(file_errors(spark, list(paths.values()), fmt, whole=True), "damaged")
    sound = sorted(set(paths) - {r["File_Name"] for r in errors.select("File_Name").collect()})
    if sound:
        raise OSError(f"rows of readable files are missing from the scan, repeat the load: {sound[:5]}")
    return errors


def probe_files(spark: SparkSession, directory: str, pattern: str, fmt: str | None = None,
                source_name: str = "", sheet: str = DEFAULT_SHEET, manifest: DataFrame | None = None) -> DataFrame:
    """R-05: one row per file that cannot be read: ``PROCESSING_ERROR`` at row 0."""
    known = file_manifest(spark, directory, pattern, fmt, sheet) if manifest is None else manifest
    return unreadable_rejects(known.filter(F.col("Error").isNotNull()), source_name)


def unreadable_rejects(errors: DataFrame, source_name: str) -> DataFrame:
    """Reject rows for (File_Name, Error)."""
    from dimkiln.functions.text import PROCESSING_PREFIX, prefixed_reason
    return errors.select(F.lit(source_name).alias("Source_Name"), "File_Name", F.lit(0).cast("long").alias("Row_Number"),
                         prefixed_reason(PROCESSING_PREFIX, F.col("Error")).alias("Rejected_Reason"))


def _unreadable(batches, fmt: str, sheet: str, whole: bool = False):
    """(file name, error) of the files of ``batches`` that do not parse."""
    import io

    import pandas as pd
    import pyarrow.orc
    import pyarrow.parquet

    from dimkiln.sources.xlsx import parse_xlsx

    def parquet(b: bytes) -> None:
        opened = pyarrow.parquet.ParquetFile(io.BytesIO(b), page_checksum_verification=whole)
        for _ in opened.iter_batches() if whole else ():
            pass

    def orc(b: bytes) -> None:
        opened = pyarrow.orc.ORCFile(io.BytesIO(b))
        for i in range(opened.nstripes if whole else 0):
            opened.read_stripe(i)

    opener = {"parquet": parquet, "orc": orc, "xlsx": lambda b: parse_xlsx(b, sheet)}[fmt]
    for batch in batches:
        found = []
        for name, content in zip(batch["File_Name"], batch["content"]):
            try:
                opener(bytes(content))
            except Exception as exc:  # any parse failure is what is being looked for
                found.append((name, f"{type(exc).__name__}: {exc}".strip().splitlines()[0]))
        yield pd.DataFrame(found, columns=["File_Name", "Error"])
