"""CSV output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.operators.staging import stage


def escaped(text: Column) -> Column:
    """The text without line breaks: a backslash becomes two, a line feed ``\\n``, a carriage return ``\\r``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _on_one_line(df: DataFrame, line_breaks: str) -> DataFrame:
    if line_breaks not in ("reject", "escape"):
        raise ValueError(f"line_breaks is {line_breaks!r}, not 'reject' or 'escape'")
    for name, kind in df.dtypes:
        if kind == "string":
            text, error = F.col(f"`{name}`"), F.raise_error(F.lit(f"line break in column {name}"))
            checked = F.when(text.rlike(r"[\r\n]"), error).otherwise(text)
            df = df.withColumn(name, escaped(text) if line_breaks == "escape" else checked)
    return df


class _Folder:
    """A path in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self.fs = self.at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.at = self.fs.makeQualified(self.at)

    def beside(self, spark: SparkSession, role: str) -> _Folder:
        """A new hidden neighbour; readers of the parent folder pass over it."""
        return _Folder(spark, f"{self.at.getParent()}/.{self.at.getName()}-{role}-{uuid.uuid4().hex}")

    def exists(self) -> bool:
        return self.fs.exists(self.at)

    def move(self, to: _Folder) -> None:
        if not self.fs.rename(self.at, to.at):
            raise OSError(f"{self.at} could not be renamed to {to.at}")

    def delete(self) -> None:
        self.fs.delete(self.at, True)

    def __str__(self) -> str:
        return self.at.toString()


def _replace(df: DataFrame, path: str, write) -> None:
    """Write aside, then put the new folder in the place of the old one."""
    spark = df.sparkSession
    target = _Folder(spark, path)
    new, old = target.beside(spark, "new"), target.beside(spark, "old")
    try:
        write(str(new))
    except BaseException:
        new.delete()
        raise
    had = target.exists()
    if had:
        target.move(old)
    try:
        new.move(target)
    except BaseException:
        if had:
            old.move(target)
        new.delete()
        raise
    if had:
        old.delete()


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    *,
    single_file: bool = False,
    line_breaks: str = "reject",
) -> None:
    """Write a CSV folder with a header line.

    ``mode`` is Spark's (``overwrite``, ``errorifexists``, ...). Overwriting writes a hidden folder beside
    ``path`` and renames it when all rows are written: a job that fails leaves the old folder as it
    was, and ``df`` may read what it replaces. The two renames are not one step; a reader in between
    finds no folder, never half of one, and where a store copies to rename they take as long.

    Quotes are doubled, white space is kept, NULL is an empty field and an empty string two quotes, so
    ``read_csv`` gives back what was written. Readers that split files between tasks could not tell a line
    break in a text from the end of a row: such a text fails the job, or with ``line_breaks="escape"``
    is written with backslashes, in every text column, which ``read_csv(..., escaped=True)``
    turns back. ``single_file`` is for reports: the rows are computed in parallel, and one task,
    however many they are, writes them.
    """
    df = _on_one_line(df, line_breaks)
    if single_file:
        df = stage(df, "report").coalesce(1)

    def write(to: str, mode: str = "errorifexists") -> None:
        (
            df.write.mode(mode)
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", None)
            .option("emptyValue", '""')
            .csv(to)
        )

    if mode == "overwrite":
        _replace(df, path, write)
    else:
        write(path, mode)
