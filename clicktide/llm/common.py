"""What the operators share: reading the tables, the shared folder, Arrow blocks of bounded size."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts that cut at ASCII white space.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that a Python task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share.

    Where it is not set, a session of one process (`local[...]`) gets a folder of its own; on a cluster that is
    an error, as no other folder is sure to be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/llm-{spark.sparkContext.applicationId}"
    return root


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and host, as Spark resolves it; tasks that open files need it so."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def shared_folder(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return qualified(spark, f"{shared_root(spark).rstrip('/')}/llm-{uuid.uuid4().hex}")


def files_of(folder: str) -> tuple:
    """The file system and the path of a qualified folder, for tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def store(frame: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends, lost executors cost nothing."""
    spark = frame.sparkSession
    folder = folder or shared_folder(spark)
    frame.write.mode("overwrite").parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def make_folder(spark: SparkSession, folder: str) -> None:
    """Create a folder through Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a stored intermediate that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken, name = {c.lower() for c in frame.columns}, f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column | str) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(text) if isinstance(text, str) else text, upper, upper.lower())


def space_words(text: Column) -> Column:
    """The runs of characters between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def text_blocks(batch: pa.RecordBatch, column: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most `limit` bytes of text (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = held = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)
