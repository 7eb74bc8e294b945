"""What the operators of this subpackage share: input columns, Arrow batches and tables in the shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workers import find_library, given_back

#: Rows in an Arrow batch: 512 texts of ordinary length are a few MB, and a batch of very long ones still fits a worker.
ARROW_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as doc_id long and text string with null as empty; other columns are left out, so none can clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fold(id_col: str, n: int):
    """crc32 of the id as text, modulo n; null ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def fold_of(doc_id: int | None, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow in batches small enough for very long texts; what Spark hands over at once is bounded by its own maxBytesPerBatch. What a task held goes back to the system when it ends."""
    find_library(df.sparkSession)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, max(1, b.num_rows), ARROW_ROWS):
                yield b.slice(k, ARROW_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(some(batches))
        finally:
            given_back()

    return df.mapInArrow(run, schema)


@contextlib.contextmanager
def batch_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Rows that Spark hands over at once, for jobs that run inside, whose rows are large; the session's setting comes back after them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without making str objects; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's; on one machine alone, as in tests, one of our own where both are unset."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not context.master().split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="watchsieve-"))
    return context.getCheckpointDir().get()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: cuts the lineage, outlives executors, and gives later steps the same rows each time."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the files of a stored() table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Ids up to which a set of them is sent to all executors (8 bytes each); a larger one is shuffled.
BROADCAST_IDS = 2_000_000


def filtered(docs: DataFrame, keep: Callable[[list[bytes]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text keep() accepts; null counts as empty."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(as_bytes(b.column(text_col))), pa.bool_()))

    return map_batches(docs, some, docs.schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id is not in ids (one column, not null); texts are shuffled only where ids are too many to broadcast."""
    name = unused(docs, "_id")
    ids = ids.toDF(name).distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, docs[id_col].cast("long") == F.col(name), "left_anti")
