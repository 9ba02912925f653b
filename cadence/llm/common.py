"""Helpers shared by the document operators."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir

#: White space of the word and normalisation rules (fixed values).
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column with NULL read as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text); every other column, whatever its name, is pruned."""
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new folder name below the session's shared checkpoint folder, with the
    scheme of its file system (Hadoop's default one for a bare path)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def scratch_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage is cut, the columns stay compressed, and a lost executor
    costs nothing. The folder is deleted when the application ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    delete_at_exit(spark, path)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more, and let Spark's cleaner
    drop the shuffles that wrote them (it learns of them by the driver's garbage
    collection)."""
    for table in tables:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(table._scratch)
        where.getFileSystem(conf).delete(where, True)
    gc.collect()
    jvm.System.gc()


def delete_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def give_back() -> None:
    """Return the memory that earlier work of this Python worker has freed to the
    system: workers are reused from stage to stage, and their allocators keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


SLICE_BYTES = 1 << 22


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of whole rows whose ``column`` (strings or lists) holds
    at most ``limit`` bytes or values, or one row."""
    ends = batch.column(column).offsets.to_numpy() if pa.types.is_list(batch.schema.field(column).type) else (
        np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def to_arrow(columns: dict[str, pa.Array | list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in columns.items()],
        schema=schema)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow file system and path of a Hadoop-style URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


_SHIPPED: set[str] = set()


#: Rows of a batch between the JVM and Python: documents are long, Spark's default of 10,000 holds too many bytes.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application: a zip in the
    shared folder, added as a Python file. Worker-side caches live in modules,
    so the functions are imported there rather than sent by value. A session that
    leaves Arrow batches at Spark's default size gets smaller ones."""
    sc = spark.sparkContext
    if int(spark.conf.get(_BATCH_SETTING)) == 10_000:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.relpath(at, os.path.dirname(root)))
    target = scratch_dir(spark, "package")
    delete_at_exit(spark, target)
    fs, path = file_system(target)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/cadence.zip") as out:
        out.write(data.getvalue())
    sc.addPyFile(f"{target}/cadence.zip")
    _SHIPPED.add(sc.applicationId)
