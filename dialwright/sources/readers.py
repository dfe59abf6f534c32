"""Tolerant file readers.  Every reader takes an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from dialwright.functions.text import strip_noise
from dialwright.operators import joins


_BAD_LINE = "__bad_line"


def text_schema(names: list[str]) -> T.StructType:
    """All columns as text, to be converted by tolerant casts later."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def repeated_group_names(leading: list[str], measures: list[str], units: int) -> list[str]:
    """Column names of a log with one repeated column group per unit."""
    return [*leading, *[f"{m}_{u}" for u in range(1, units + 1) for m in measures]]


def read_positional_csv(spark: SparkSession, path: str, names: list[str], sep: str = ";") -> DataFrame:
    """Headered CSV whose header repeats names: the header is skipped, names go by position.

    Lines wider or narrower than ``names`` are left out; :func:`positional_rejects` returns them.
    """
    return _positional(spark, path, names, sep).filter(F.col(_BAD_LINE).isNull()).drop(_BAD_LINE)


def positional_rejects(spark: SparkSession, path: str, names: list[str], sep: str = ";") -> DataFrame:
    """The lines :func:`read_positional_csv` leaves out, as ``line`` with their ``file``."""
    bad = _positional(spark, path, names, sep).filter(F.col(_BAD_LINE).isNotNull())
    return bad.select(F.col(_BAD_LINE).alias("line"), F.col("_metadata.file_name").alias("file"))


def _positional(spark: SparkSession, path: str, names: list[str], sep: str) -> DataFrame:
    """All lines; one of another width has its text in ``_BAD_LINE``.

    Column pruning is off for this read: a line's width shows only when all of
    its cells are parsed.
    """
    lines = (
        spark.read.schema(text_schema([*names, _BAD_LINE]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .option("columnPruning", False)
        .option("sep", sep)
        .csv(path)
    )
    # Spark refuses to read the bad lines' column alone; this condition always holds and names another one.
    return lines.filter(F.substring(F.coalesce(F.col(names[0]), F.lit("")), 1, 0) == "")


def read_sensor_csv(
    spark: SparkSession, path: str, value_col: str, delta_col: str, encoding: str = "UTF-16LE", sep: str = ";"
) -> DataFrame:
    """Five-column sensor export: date, time, unit, value, variation, all as text.

    The line separator is given explicitly, which lets Spark split a UTF-16
    file among tasks.  Byte-order mark, quotes and carriage returns are
    stripped from the cells.
    """
    names = ["date_raw", "time_raw", "unit_raw", value_col, delta_col]
    raw = (
        spark.read.schema(text_schema(names))
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("lineSep", "\n")
        .csv(path)
    )
    return raw.select(*[strip_noise(n).alias(n) for n in names])


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",") -> DataFrame:
    """Headered CSV with a given schema; columns are found by name, cells that do not convert become NULL.

    Files may order their columns differently and have further ones; one that
    lacks a column stops the read.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    frames = []
    for names, files in _files_by_header(spark, path, sep).items():
        missing = [n for n in struct.names if n not in names]
        if missing:
            raise ValueError(f"{files[0]}: missing columns {missing}; found {sorted(names)}")
        types = {f.name: f.dataType for f in struct.fields}
        own = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        frames.append(spark.read.schema(own).option("header", True).option("sep", sep).csv(files).select(*struct.names))
    return joins.union_kinds(frames) if frames else spark.createDataFrame([], struct)


def _files_by_header(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their header cells; only first lines are fetched.

    Runs where Spark lists the files anyway and keeps one entry per distinct header.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    java = spark._jvm.java.io
    settings = spark._jsc.hadoopConfiguration()
    for name in sorted(spark.read.text(path).inputFiles()):
        # Spark reports files as URIs; one with spaces arrives escaped.
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        reader = java.BufferedReader(java.InputStreamReader(where.getFileSystem(settings).open(where), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line is not None:
            cells = tuple(cell.replace('"', "").strip("\ufeff\r ") for cell in line.split(sep))
            found.setdefault(cells, []).append(where.toString())
    return found


def _header(spark: SparkSession, path: str, sep: str, quote: str) -> list[str]:
    """Header cells of the first file; only its first line is fetched."""
    lines = spark.read.text(path).limit(1).collect()
    if not lines:
        raise ValueError(f"no header line in {path}")
    return [cell.replace(quote, "").strip("\ufeff\r ") for cell in lines[0][0].split(sep)]


def unique_headers(headers: list[str], meanings: dict[int, str] | None = None) -> list[str]:
    """Distinct column names for a header that repeats itself.

    ``meanings`` names positions outright; other repeats get their position
    appended.
    """
    meanings = meanings or {}
    repeated = {h for h in headers if headers.count(h) > 1}
    return [meanings.get(i, f"{h}{i}" if h in repeated else h) for i, h in enumerate(headers)]


def rename_duplicates(df: DataFrame, meanings: dict[int, str]) -> DataFrame:
    """Rename columns by position."""
    return df.toDF(*[meanings.get(i, c) for i, c in enumerate(df.columns)])


def read_tsv_unquoted(
    spark: SparkSession, path: str, names: list[str] | None = None, meanings: dict[int, str] | None = None
) -> DataFrame:
    """TSV in which quotes are ordinary characters; they are removed from the header.

    Without ``names`` the header line is read and made unique, using
    ``meanings`` for repeated ones.  All columns are text.
    """
    names = names or unique_headers(_header(spark, path, "\t", '"'), meanings)
    return (
        spark.read.schema(text_schema(names))
        .option("header", True)
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """Parquet table, restricted to ``cols`` when given."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because the path does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_config(spark: SparkSession, path: str, schema: str | T.StructType, default: DataFrame) -> DataFrame:
    """JSON document (object or list) as rows; ``default`` only if the file is missing.

    A file that exists but lacks a required field is an error for the caller
    to see, not a reason to fall back.
    """
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if is_missing(error):
            return default
        raise


def json_rows(df: DataFrame, text: str, schema: str) -> DataFrame:
    """JSON list held in a text column, one row per element."""
    return df.select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    """Fail with the list of missing columns, else pass ``df`` through."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; found {sorted(df.columns)}")
    return df


def read_validated(spark: SparkSession, path: str, required: list[str], sep: str = ",") -> DataFrame:
    """Headered CSV of text columns that must contain ``required``, in every file and in any order.

    Columns that only some files have are NULL for the others.
    """
    frames = []
    for names, files in _files_by_header(spark, path, sep).items():
        df = spark.read.schema(text_schema(list(names))).option("header", True).option("sep", sep).csv(files)
        frames.append(require_columns(df, required, files[0]))
    if not frames:
        raise ValueError(f"no header line in {path}")
    return joins.union_kinds(frames)
