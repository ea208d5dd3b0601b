"""Conditional append to a partitioned Parquet table, and objects as files."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from ..session import scratch_path, shuffles_dropped

COLUMNS = "_columns"        # beside the partitions; Spark's readers leave out names that begin so


def _exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system: reading a path that is not there is a failed query to Spark's listeners and event log."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _partition(columns: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def stored_keys(spark: SparkSession, path: str, like: DataFrame, partitions: list[str], key: list[str]) -> DataFrame | None:
    """The keys (partition columns and key) that the table has in the partitions
    of ``like``; None if there is no table yet. The partitions that one append
    touches are listed (as many as the folders it writes), so all others are
    pruned before a file is opened, and only the key columns are read."""
    if not _exists(spark, path):
        return None
    store = spark.read.schema(like.schema).parquet(path)
    touched = [r[0] for r in like.select(_partition(partitions)).distinct().collect()]
    return store.filter(_partition(partitions).isin(touched)).select(*partitions, *key)


def _columns(spark: SparkSession, path: str) -> StructType | None:
    """The columns of the table as its first append noted them, or else as its files have them; None: neither is there."""
    for at in (f"{path}/{COLUMNS}", path):
        if not _exists(spark, at):
            continue
        try:
            return spark.read.parquet(at).schema
        except AnalysisException as e:      # an append that stopped early
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    return None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``append_new`` wrote; one that got no row so far has its columns too."""
    columns = _columns(spark, path)
    return (spark.read.schema(columns) if columns else spark.read).parquet(path)


def append_new(rows: DataFrame, path: str, partitions: list[str], key: list[str]) -> None:
    """Adds the rows whose key the table does not have; nothing stored is
    touched, so a rerun changes nothing. ``rows`` is read twice: give stored rows.

    Rows are range-partitioned on partition columns and key, so a partition
    lands in few files and a hot one is split over several tasks. A partitioned
    write of no rows leaves no file, so the first append notes the columns.
    """
    held = None
    if _columns(rows.sparkSession, path) is None:
        last = [*[c for c in rows.columns if c not in partitions], *partitions]
        rows.select(*last).limit(0).write.mode("overwrite").parquet(f"{path}/{COLUMNS}")
    else:
        held = stored_keys(rows.sparkSession, path, rows, partitions, key)
    if held is not None:
        rows = rows.join(held, [*partitions, *key], "left_anti").select(*rows.columns)
    rows.repartitionByRange(*partitions, *key).write.mode("append").partitionBy(*partitions).parquet(path)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again; the write's shuffle files go when it ends."""
    return staged_at(rows, scratch_path(rows.sparkSession, name))


def staged_at(rows: DataFrame, path: str) -> DataFrame:
    """``staged`` at a path, for what is removed before the end."""
    with shuffles_dropped(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# objects: one file each ---------------------------------------------------------

def _qualified(spark: SparkSession, path: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")


def _files(root: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if root.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), re.sub("^file:/+", "/", root)
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", root))


def _there(fs: pyarrow.fs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type == pyarrow.fs.FileType.File


def write_objects(groups: DataFrame, root: str) -> DataFrame:
    """Writes objects as files under ``root``, a row of ``groups`` (objects:
    array of key and body, marker: key) at a time: its objects, then the empty
    marker. A group whose marker is there is left alone; one that a lost task
    wrote in part is written again. Gives (marker, written) of each group."""
    root = _qualified(groups.sparkSession, root)
    fs, at = _files(root)
    fs.create_dir(at)       # without groups, an empty folder

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _files(root)
        for b in batches:
            markers, new = b.column("marker").to_pylist(), []
            for marker, objects in zip(markers, b.column("objects").to_pylist(), strict=True):
                new.append(not _there(fs, f"{at}/{marker}"))
                if new[-1]:
                    # a text file ends its last line; Spark's readers leave out files of no bytes
                    for key, body in [*((o["key"], (o["body"] or "") + "\n") for o in objects), (marker, "")]:
                        fs.create_dir(f"{at}/{key}".rpartition("/")[0])
                        with fs.open_output_stream(f"{at}/{key}") as out:
                            out.write(body.encode())
            yield pa.RecordBatch.from_arrays([pa.array(markers, pa.string()), pa.array(new, pa.bool_())], ["marker", "written"])

    return staged(groups.select("objects", "marker").mapInArrow(put, "marker string, written boolean"), "objects-written")


def scan_objects(spark: SparkSession, root: str, names: str = "*", marker: str | None = None) -> DataFrame:
    """(object_key, body) of the files under ``root`` whose names match, the key taken from the file's
    path. With ``marker``, only of folders that hold a file of that name."""
    root = _qualified(spark, root)
    objects = spark.read.format("text").options(wholetext=True, recursiveFileLookup=True, pathGlobFilter=names).load(root)
    # the path is a URI: everything but "+" is escaped as url_decode expects
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    start = F.locate(re.sub("^[a-z0-9]+:/*", "/", root) + "/", path)
    key = F.substring(path, start + len(re.sub("^[a-z0-9]+:/*", "/", root)) + 1, F.length(path))
    found = objects.select(key.alias("object_key"), F.left("value", F.length("value") - 1).alias("body"))
    if marker is None:
        return found

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _files(root)
        for b in batches:
            yield b.filter(pa.array([_there(fs, f"{at}/{k.rpartition('/')[0]}/{marker}") for k in b.column("object_key").to_pylist()], pa.bool_()))

    return found.mapInArrow(complete, found.schema)
