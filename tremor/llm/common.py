"""Helpers shared by the operators of this subpackage: table access, lineage cuts, label samples, batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.shared import shared_dir

#: Text bytes that one vectorised step works on; a longer text is a step of its own.
CHUNK_BYTES = 1 << 19

#: Remainder of crc32(doc_id as text) modulo 4 that marks held-out documents.
HELD_OUT = 2


#: Rows of an Arrow batch; whole texts are long, and a batch is held on both sides of the pipe to a Python worker.
BATCH_ROWS = 256

#: Share of its bound that the driver's heap may take after a table is written; a long chain of plans and broadcasts would keep it at its bound, beside all that lies outside the heap.
GROWN = 0.5

#: Bytes of a table that may be broadcast where tables grow with the corpus. Spark goes by the size of compressed files; the driver holds the rows, their hash table and what is sent of it, of several tables at once.
BROADCAST = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Meanwhile the session has ``value`` for ``key``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextlib.contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Meanwhile tables over BROADCAST bytes are joined by shuffles, whatever the session allows; a lower bound of its own stays."""
    first, later = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    with contextlib.ExitStack() as held:
        for key, now in ((first, spark.conf.get(first)), (later, spark.conf.get(later, None))):
            if now and not now.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > BROADCAST:
                held.enter_context(setting(spark, key, str(BROADCAST)))
        yield


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it again: what follows neither recomputes it nor depends on executors that may be lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tremor/{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # nothing needs the shuffle files of this plan once it is written
        df.write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}).parquet(path)
    give_back_driver(spark, GROWN)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._cut)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def give_back_driver(spark: SparkSession, over: float = 0) -> None:
    """The same for the driver's JVM if its heap takes over that share of its bound: a collection shrinks it to what is in use, and Spark's cleaner drops what went out of use."""
    give_back()
    heap = spark._jvm.Runtime.getRuntime()
    if heap.totalMemory() > over * heap.maxMemory():
        spark._jvm.System.gc()


def share(spark: SparkSession, value):
    """A broadcast of which the driver's Python keeps no copy in memory; its file is read again if need be."""
    out = spark.sparkContext.broadcast(value)
    vars(out).pop("_value", None)
    return out


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and then the memory that it used goes back to the system: Python workers live on, and what one step leaves in them adds to the next step's need."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose ``column`` holds about ``most`` bytes at most, a row at least."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = text_buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of Arrow batches dealt anew, so that ``column`` holds about ``most`` bytes, a row at least."""
    held, size = [], 0
    for b in pieces(batches, column, most):
        _, ends = text_buffers(b.column(b.schema.get_field_index(column)))
        own = int(ends[-1] - ends[0])
        if held and size + own > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += own
    if held:
        yield pa.concat_batches(held)


def text_buffers(texts: pa.Array):
    """(bytes, offsets) of a string or binary array as numpy arrays without a copy; null is empty."""
    import numpy as np

    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32, texts.offset + len(texts) + 1)[texts.offset :].astype(np.int64)
    if texts.null_count:  # a null may own bytes that were not cleared
        if (np.diff(ends)[texts.is_null().to_numpy(zero_copy_only=False)] > 0).any():
            return text_buffers(texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b""))
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole, ends


def row_hash(*columns: str) -> F.Column:
    """A 64-bit hash of the values of a row in which a null is a value of its own."""
    return F.xxhash64(*[c for name in columns for c in (F.isnull(F.col(f"`{name}`")), F.col(f"`{name}`"))])


def held_out(doc_id) -> F.Column:
    """False for a null id, whose text has no crc32."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def labelled(labels: DataFrame, what: str) -> DataFrame:
    """(doc_id, y) of the documents whose labels may be learned from; repeated rows of an id count once, with the larger label."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(what).isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(F.col(what).cast("int")).alias("y"))


def label_sample(labels: DataFrame, what: str, most: int) -> list[tuple[int, int]]:
    """(doc_id, y) of at most ``most`` rows of ``labelled``, those of the smallest hash: the same rows for the same table at any layout."""
    rows = labelled(labels, what).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    return [(r.doc_id, r.y) for r in rows]


def only_columns(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns; extra columns of any name are not looked at."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def wrapped(docs: DataFrame, *more, keep: list[str] | None = None) -> DataFrame:
    """``more`` beside ``row``, a struct of the columns of ``docs`` (or of those in ``keep``): whatever they are called, no name clashes with those that an operator adds."""
    names = docs.columns if keep is None else keep
    return docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("row"), *more)


def unwrapped(rows: DataFrame, names: list[str], **more) -> DataFrame:
    """The columns ``names`` that ``wrapped`` put into ``row``, but those that ``more`` replaces, and ``more``."""
    return rows.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names) if c not in more], *[c.alias(n) for n, c in more.items()])
