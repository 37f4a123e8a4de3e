"""Intermediate tables that must be computed once and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_written: list[str] = []


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="palate-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The context's checkpoint folder will do too. A session that runs on this machine only
    and names neither gets a temporary one; on a cluster a machine-local folder would be
    invisible to other nodes, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        named = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = named.get() if named.isDefined() else None
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every node shares")
    return _local_root()


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that no frame reads any more."""
    for df in staged:
        read = {file.rpartition("/")[0].rpartition("/")[2] for file in df.inputFiles()}
        for path in [path for path in _written if path.rpartition("/")[2] in read]:
            _delete(df.sparkSession, path)
            _written.remove(path)


def clear_staged(spark: SparkSession, keep: DataFrame | None = None, label: str = "") -> None:
    """Delete the tables that this process has staged under labels that begin so, but for those
    that ``keep`` reads. Other frames that read them are void then, so call it when their
    results are written."""
    found = [path for path in _written if path.rpartition("/")[2].startswith(label)]
    if not found:
        return
    read = {file.rpartition("/")[0].rpartition("/")[2] for file in keep.inputFiles()} if keep else ()
    for path in [path for path in found if path.rpartition("/")[2] not in read]:
        _delete(spark, path)
        _written.remove(path)


def _width(df: DataFrame) -> Column:
    """Bytes that a row takes in a hashed table, roughly from above: its header and map entry, eight a
    value, and the padded length of what does not fit in eight."""
    total = F.lit(64 + 8 * len(df.columns))
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            if not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
                continue
            value = value.cast("string")  # no shorter than its eight bytes a number, but for small ones
        total = total + F.coalesce(8 * F.ceil(F.octet_length(value) / 8), F.lit(0))
    return total


@dataclass(frozen=True)
class Staged:
    """A staged table with the size that was counted while it was written."""

    df: DataFrame
    rows: int
    bytes: int


def stage_measured(df: DataFrame, label: str = "stage") -> Staged:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The table cuts the lineage and is read by any number of later jobs. Rows and their
    size in a hashed table are counted in the same pass; work that was repeated after a
    failure can only raise the counts.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    size = Observation()
    df.observe(
        size,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_width(df)), F.lit(0)).alias("bytes"),
    ).write.parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), size.get["rows"], size.get["bytes"])


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """``stage_measured`` where only the table is wanted."""
    return stage_measured(df, label).df
