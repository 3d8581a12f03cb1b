"""Files on the file system of a path: listing as a scan, deletion in tasks, and names that only one writer can take."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root and the root's path on it, for use in tasks."""
    local = re.sub(r"^file:/+", "/", root)
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(local)


def _java(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what a pattern matches, for folders with few files."""
    where, system = _java(spark, pattern)
    return sorted(f.getPath().getName() for f in system.globStatus(where) or [])


def read_small(spark: SparkSession, path: str) -> str:
    where, system = _java(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, or return False if the name is taken.

    The content is written under another name and renamed without overwriting, so of several writers one succeeds and no reader
    sees a part.
    """
    where, system = _java(spark, path)
    draft, _ = _java(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.draft")
    stream = system.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    keep = getattr(hadoop, "Options$Rename").NONE
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = keep
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(where), options)
    except Py4JJavaError as error:
        if not system.exists(where):
            raise
        system.delete(draft, False)
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    return True


def files_below(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """path (below the root) of every file that matches; the listing runs as a scan and no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    base = re.sub(r"^file:/+", "/", root.rstrip("/")) + "/"
    return found.select(F.substring_index("path", base, -1).alias("path"))


def remove_paths(paths: DataFrame, root: str) -> DataFrame:
    """Delete files and folders (path below root) in tasks; the paths, as a written table. What is gone already counts as deleted."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                kind = system.get_file_info(f"{base}/{path}").type
                if kind == fs.FileType.File:
                    system.delete_file(f"{base}/{path}")
                elif kind == fs.FileType.Directory:
                    system.delete_dir(f"{base}/{path}")
            yield batch

    spark, out = paths.sparkSession, scratch_path(paths.sparkSession, "removed")
    paths.select("path").mapInArrow(work, "path string").write.parquet(out)
    return spark.read.parquet(out)
