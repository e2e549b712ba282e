"""What the corpus operators share: shared storage, Arrow batches as numpy."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in a batch that goes to Python; blocks() cuts batches by bytes as well.
BATCH_ROWS = 1000
#: Bytes of text that numpy code works on at once.
BLOCK_BYTES = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, also where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session on one machine that has none (tests) gets a folder there; on a
    cluster such a folder would not be shared, and that is an error.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quaybook-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it: cuts lineage, survives lost executors. drop() deletes it."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.shared_folder = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that table() made, when what follows from them is written.

    The shuffles behind them are of no more use either: once the driver has forgotten
    their plans, Spark's cleaner removes their files.
    """
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.shared_folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    for df in tables[:1]:
        df.sparkSession.sparkContext._jvm.System.gc()


def sparing(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Columns whose names begin with an underscore, as those do that operators use within, pass through untouched."""

    @wraps(operator)
    def wrapped(docs: DataFrame, *args: object, **kwargs: object) -> DataFrame:
        used = {x for x in (*args, *kwargs.values()) if isinstance(x, str)}
        aside = {c: f"aside{i}_{uuid.uuid4().hex}" for i, c in enumerate(docs.columns) if c.startswith("_") and c not in used}
        return operator(docs.withColumnsRenamed(aside), *args, **kwargs).withColumnsRenamed({v: k for k, v in aside.items()})

    return wrapped


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each row's begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, at, data = column.buffers()
    starts = np.frombuffer(at, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a block has about `size` bytes in `column`; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = texts(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(starts, starts[row] + size, side="right")) - 1)
            yield batch.slice(row, end - row)
            row = end


def tidily(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and at a task's end its memory goes back to the system: idle Python workers stay beside the next stage's JVM."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; base is odd."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        with np.errstate(over="ignore"):
            steps = np.multiply.accumulate(steps, axis=1)
        known = _POWERS[base] = (steps[0], steps[1])
    return known[0][:n], known[1][:n]


def rolling(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, inverse powers): the hash of values[i:j] is (sums[j] - sums[i]) * inverse[i]."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[:-1], out=sums[1:])
    return sums, down


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
