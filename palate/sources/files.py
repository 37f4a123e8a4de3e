"""CSV and Parquet scans of the five input tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.sinks import write_csv
from palate.sources.schemas import SCHEMAS, Tables

# The file names under which the five tables are published.
CSV_FILES = {
    "movies": "movies.csv",
    "ratings": "ratings.csv",
    "tags": "tags.csv",
    "genome_scores": "genome-scores.csv",
    "genome_tags": "genome-tags.csv",
}

# The published ratings and tags files carry a fourth column that no query uses.
# Declaring it keeps four-column lines well-formed; three-column files read the
# same, because the reader fills missing trailing columns with NULL.
_TRAILING_TIMESTAMP = {"ratings", "tags"}

# These two are read by the names in their header, the others by position.
_BY_NAME = {"movies", "genome_tags"}

# No text holds this character; so no text is taken for NULL but the empty field.
_NO_TEXT = "\ufffe"


def _plain(name: str) -> str:
    return name.strip().lower().replace("_", "")


def _header(spark: SparkSession, path: str) -> list[str]:
    """The fields of the first line; the reader takes each file's first line for its header."""
    first = spark.read.option("header", False).option("quote", '"').option("escape", '"').csv(path).head()
    return [value or "" for value in (first or [])]


def _schema_on_disk(spark: SparkSession, table: str, path: str, header: bool) -> T.StructType:
    """The columns as they lie in the file; any but the table's own are unnamed texts."""
    schema = SCHEMAS[table]
    if header and table in _BY_NAME:
        by_name = {_plain(field.name): field for field in schema.fields}
        names = [_plain(value) for value in _header(spark, path)]
        if missing := [name for name in by_name if names.count(name) != 1]:
            raise ValueError(f"{path}: the header has {names}, not one each of {missing}")
        return T.StructType(
            [by_name.get(name, T.StructField(f"_unused{i}", T.StringType())) for i, name in enumerate(names)]
        )
    if table in _TRAILING_TIMESTAMP:
        return T.StructType([*schema.fields, T.StructField("timestamp", T.StringType(), True)])
    return schema


def _reader(spark: SparkSession, schema: T.StructType, header: bool) -> DataFrameReader:
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NO_TEXT)
        .option("mode", "PERMISSIVE")
    )


def unescaped(text: Column) -> Column:
    """The text that ``csv_sink.escaped`` wrote: ``\\\\`` stands for a backslash, ``\\n`` and ``\\r`` for line breaks."""

    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), breaks), "\\")


def _texts(df: DataFrame, escaped: bool) -> DataFrame:
    if not escaped:
        return df
    return df.select(*(unescaped(F.col(f"`{n}`")).alias(n) if kind == "string" else F.col(f"`{n}`") for n, kind in df.dtypes))


def read_csv(
    spark: SparkSession, table: str, path: str, *, header: bool = True, escaped: bool = False
) -> DataFrame:
    """Scan one CSV table with its fixed schema; no type is inferred.

    Movies and genome tags are read by the names in the header, in any order and among
    other columns, ignoring case and underscores; a missing name is an error. All files of a
    folder must have one header. Quotes inside quoted fields are doubled (``""``). An empty
    field, and a value that does not parse as its column type, is NULL; two quotes are an
    empty string. Files are split between tasks, so a quoted field may not contain a line break;
    ``escaped`` reads what ``write_csv`` wrote with ``line_breaks="escape"``.

    A line that does not fit is read as far as it does; ``read_csv_checked`` tells such lines apart.
    """
    schema = SCHEMAS[table]
    found = _reader(spark, _schema_on_disk(spark, table, path, header), header).csv(path)
    return _texts(found.select(*schema.fieldNames()), escaped)


def read_result(spark: SparkSession, schema: str, path: str, *, escaped: bool = False) -> DataFrame:
    """A CSV folder of ``write_csv`` with the columns of a DDL schema."""
    return _texts(_reader(spark, T.StructType.fromDDL(schema), True).csv(path), escaped)


@dataclass(frozen=True)
class Checked:
    """A CSV table with the lines that do not fit set apart.

    ``rows`` are the table's columns of the lines that fit, ``bad_lines`` (file, line) the others as they
    are in their files. Both are lazy and read the files, each for itself."""

    rows: DataFrame
    bad_lines: DataFrame

    def counts(self) -> DataFrame:
        """(file, n_bad): how many lines of each file do not fit; files without one are absent."""
        return self.bad_lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_bad"))


def read_csv_checked(spark: SparkSession, table: str, path: str, *, header: bool = True) -> Checked:
    """``read_csv`` with a quarantine.

    A line does not fit if it has another number of fields than the header (without a header: than the
    table), or if a number in it can not be read. Empty fields fit and are NULL. A bad line is kept whole and
    gives no row, so a rating that can not be read is no silent NULL.
    """
    schema, corrupt = SCHEMAS[table], "_corrupt"
    if header and table not in _BY_NAME:
        extra = [T.StructField(f"_unused{i}", T.StringType()) for i in range(len(_header(spark, path)) - len(schema))]
        on_disk = T.StructType([*schema.fields, *extra])
    else:
        on_disk = _schema_on_disk(spark, table, path, header) if header else schema
    on_disk = T.StructType([*on_disk.fields, T.StructField(corrupt, T.StringType())])
    found = _reader(spark, on_disk, header).option("columnNameOfCorruptRecord", corrupt).csv(path)
    # Spark refuses to read the corrupt line alone, and looks at no field that is not asked for. So both sides
    # ask how many fields came out, which needs all of them.
    values = F.array(*(F.col(f"`{name}`").cast("string") for name in on_disk.fieldNames() if name != corrupt))
    found = found.filter(F.size(F.filter(values, lambda value: value.isNotNull())) >= 0)
    rows = found.filter(F.col(corrupt).isNull()).select(*schema.fieldNames())
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return Checked(rows, found.filter(F.col(corrupt).isNotNull()).select(file.alias("file"), F.col(corrupt).alias("line")))


def read_csv_tables(spark: SparkSession, folder: str, quarantine: str | None = None) -> Tables:
    """Scan the five published CSV files of one folder.

    With ``quarantine`` the lines that do not fit go there, a CSV folder (file, line) per table,
    and the tables hold the others; without, lines are read as far as they fit.
    """
    root, tables = folder.rstrip("/"), {}
    for name, file in CSV_FILES.items():
        if quarantine is None:
            tables[name] = read_csv(spark, name, f"{root}/{file}")
        else:
            checked = read_csv_checked(spark, name, f"{root}/{file}")
            write_csv(checked.bad_lines, f"{quarantine.rstrip('/')}/{name}")
            tables[name] = checked.rows
    return Tables(**tables)


def read_parquet_tables(spark: SparkSession, folder: str) -> Tables:
    """Scan the five tables from ``<folder>/<table>.parquet``."""
    root = folder.rstrip("/")
    return Tables(
        **{
            name: spark.read.schema(schema).parquet(f"{root}/{name}.parquet")
            for name, schema in SCHEMAS.items()
        }
    )
