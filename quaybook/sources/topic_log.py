"""Logs of topics in shared storage, for where there is no broker: records of (topic, partition, offset).

append() writes records as segments, sorted files of one partition's offsets, and then an index of them: what isn't
in an index isn't there, and an append that has its index isn't made again, so a
replayed micro-batch leaves each record once. The stream source goes by offsets alone: a micro-batch
takes up to so many records of each partition, whatever the times of the files.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Records of a segment, and of each partition in a micro-batch.
SEGMENT_ROWS = 20_000
#: Segments whose footers a task reads.
INDEX_FILES = 64
_INDEX = pa.schema([("file", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64())])


def _storage(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _cut(records: DataFrame, like: DataFrame, rows: int, derived: dict[str, Column]) -> DataFrame:
    """records with what is derived of them, and _b: runs of offsets, of about `rows` records of a partition each, as densely as offsets stand in `like`; a run is in one task."""
    dense = like.groupBy("topic", "partition").agg(F.min("offset").alias("_low"), F.ceil((F.max("offset") - F.min("offset") + 1) / F.count("*") * rows).cast("long").alias("_width"))
    dense = dense.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "_low", "_width")
    topic, partition, offset = (derived.get(c, F.col(c)) for c in ("topic", "partition", "offset"))
    held = records.join(F.broadcast(dense), [topic == F.col("_topic"), partition == F.col("_partition")], "left")  # a row for each partition, as the index has
    run = F.floor((offset - F.coalesce("_low", F.lit(0))) / F.coalesce("_width", F.lit(rows))).cast("long")
    return held.select(*records.columns, run.alias("_b")).repartition(topic, partition, "_b").withColumns(derived)


def _offsets(segment: pq.ParquetFile) -> tuple[int | None, int | None]:
    """A segment's least and largest offset, as its footer says; only where that says nothing the column is read."""
    meta = segment.metadata
    at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == "offset")
    told = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    if all(x is not None and x.has_min_max for x in told):
        return min(x.min for x in told), max(x.max for x in told)
    found = pc.min_max(segment.read(columns=["offset"]).column("offset")).as_py()
    return found["min"], found["max"]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment what the index says of it: all of its records are of one partition, so the first one tells which."""
    for batch in batches:
        rows = []
        for file in batch.column("file").to_pylist():
            fs, at = _storage(file)
            with fs.open_input_file(at) as opened:
                segment = pq.ParquetFile(opened)
                if segment.metadata.num_rows:
                    (of,) = next(segment.iter_batches(1, columns=["topic", "partition"])).to_pylist()
                    first, last = _offsets(segment)
                    rows.append({"file": file, **of, "first": first, "last": last, "n": segment.metadata.num_rows})
        yield pa.RecordBatch.from_pylist(rows, _INDEX)


def _index(segments: DataFrame) -> DataFrame:
    """The index of what has just been written: a row for each segment, by its footer. Its records aren't read again, and nothing is shuffled."""
    files = segments.inputFiles()
    listed = segments.sparkSession.createDataFrame(pa.table({"file": pa.array(files, pa.string())})).coalesce(max(1, -(-len(files) // INDEX_FILES)))
    return listed.mapInArrow(_described, "file string, topic string, partition int, first bigint, last bigint, n bigint")


def append(records: DataFrame, path: str, name: str, rows: int = SEGMENT_ROWS, like: DataFrame | None = None, together: bool = False, derived: dict[str, Column] | None = None) -> bool:
    """Add records (topic, partition, offset, ...) to the log; False if an append of this name is there already.

    Offsets are given, each once in its partition, and rise from one append to the next. Records are reckoned once to be written;
    how dense their offsets are is asked of `like`, if they are costly: (topic, partition, offset) of the same partitions, about as many.
    With `together` each partition's records are in one task already, as after a window over them. Columns that are
    `derived` from the records' own are added where they are written: what is dealt out goes without them.
    """
    spark = records.sparkSession
    if _exists(spark, f"{path}/index/{name}/_SUCCESS"):
        return False
    whole = records.withColumns(derived) if derived else records
    runs = whole.withColumn("_b", F.lit(0)) if together else _cut(records, whole if like is None else like, rows, derived or {})
    placed = runs.withColumns({"_t": F.col("topic"), "_p": F.col("partition")}).sortWithinPartitions("_t", "_p", "_b", "offset")
    placed.write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy("_t", "_p", "_b").parquet(f"{path}/segments/{name}")
    _index(spark.read.schema(whole.schema).parquet(f"{path}/segments/{name}")).write.mode("overwrite").parquet(f"{path}/index/{name}")
    return True


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All records of the log, as a table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    whole = [f"{path}/segments/{name}" for name in names if _exists(spark, f"{path}/index/{name}/_SUCCESS")]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*whole)


def _listed(path: str, known: set[str]) -> list[pafs.FileInfo]:
    """The appends that are whole, but for those known."""
    fs, root = _storage(path)
    found = [x for x in fs.get_file_info(pafs.FileSelector(f"{root}/index", allow_not_found=True)) if x.path not in known]
    return [x for x, done in zip(found, fs.get_file_info([f"{x.path}/_SUCCESS" for x in found]), strict=True) if done.type != pafs.FileType.NotFound]


class Share(InputPartition):
    """What a task reads: of some segments the records from `begin` to before `end`."""

    def __init__(self) -> None:
        self.segments: list[tuple[str, int, int]] = []


class LogReader(DataSourceStreamReader):
    """Offsets are {"topic/partition": next offset}.

    Spark asks for the latest offset once for each micro-batch; the answer is a bounded step beyond the last one. Where a
    restarted query has come to is in the file `position`, one micro-batch late at most: then the first
    step leads to where the query is, and the next one beyond it.
    """

    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.path, self.rows = options["path"], int(options.get("rows", SEGMENT_ROWS))
        self.pattern = re.compile(options.get("subscribepattern", ".*"))
        self.starting, self.position = options.get("startingoffsets", "latest"), options.get("position")
        if self.starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is earliest or latest")
        self.names = schema.fieldNames()
        self.known: dict[str, list[tuple[int, int, int, str]]] = {}
        self.seen: set[str] = set()
        self.at: dict[str, int] | None = None

    def _refresh(self) -> None:
        for x in _listed(self.path, self.seen):
            self.seen.add(x.path)
            for row in pq.read_table(x.path, filesystem=_storage(self.path)[0]).to_pylist():
                if self.pattern.fullmatch(row["topic"]):
                    self.known.setdefault(f"{row['topic']}/{row['partition']}", []).append((row["first"], row["last"], row["n"], row["file"]))
        for segments in self.known.values():
            segments.sort()

    def initialOffset(self) -> dict:  # noqa: N802
        if self.starting == "earliest":
            return {}
        self._refresh()
        return {k: segments[-1][1] + 1 for k, segments in self.known.items()}

    def latestOffset(self) -> dict:  # noqa: N802
        self._refresh()
        if self.at is None:
            self.at = self._remembered()
            if self.at is None:
                self.at = self.initialOffset()
        step = dict(self.at)
        for k, segments in self.known.items():
            taken = 0
            for first, last, n, _ in segments:
                if last >= step.get(k, 0):
                    if taken and taken + n > self.rows:
                        break
                    taken += n
                    step[k] = last + 1
                    if taken >= self.rows:
                        break
        self.at = step
        return step

    def partitions(self, start: dict, end: dict) -> list[Share]:
        """A task for about SEGMENT_ROWS records, of however many topics: each task costs, whatever it reads."""
        self._refresh()
        self.at = end
        shares, size = [], SEGMENT_ROWS
        for k, to in end.items():
            begin = start.get(k, 0)
            for first, last, n, file in self.known.get(k, []):
                if last >= begin and first < to:
                    if size + n > SEGMENT_ROWS:
                        shares.append(Share())
                        size = 0
                    shares[-1].segments.append((file, begin, to))
                    size += n
        return shares

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for file, begin, end in partition.segments:
            fs, at = _storage(file)
            for batch in pq.ParquetFile(fs.open_input_file(at)).iter_batches(columns=list({*self.names, "offset"})):
                offset = batch.column("offset")
                ends = pc.min_max(offset).as_py()
                if offset.null_count or ends["min"] < begin or ends["max"] >= end:  # mostly a micro-batch takes a segment as a whole
                    batch = batch.filter(pc.and_(pc.greater_equal(offset, begin), pc.less(offset, end)))
                if batch.num_rows:
                    yield batch.select(self.names)

    def commit(self, end: dict) -> None:
        if self.position:
            fs, file = _storage(self.position)
            fs.create_dir(file.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(f"{file}.new") as out:
                out.write(json.dumps(end).encode())
            fs.move(f"{file}.new", file)

    def _remembered(self) -> dict | None:
        if not self.position:
            return None
        fs, file = _storage(self.position)
        if fs.get_file_info(file).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(file) as f:
            return json.loads(f.read())


class TopicLog(DataSource):
    """Options: path, subscribePattern (all of a topic's name, default any), startingOffsets (earliest or latest), rows, position (a file beside the query's checkpoint)."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def streamReader(self, schema: StructType) -> LogReader:  # noqa: N802
        return LogReader({k.lower(): v for k, v in self.options.items()}, schema)


def stream(spark: SparkSession, path: str, schema: StructType | str, checkpoint: str, pattern: str = ".*", starting: str = "earliest", rows: int = SEGMENT_ROWS) -> DataFrame:
    """The log's topics whose names match, as a stream; `checkpoint` is that of the query that reads it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Spark's planner runs in a Python of its own
    spark.dataSource.register(TopicLog)
    options: dict[str, Any] = {"path": path, "subscribePattern": pattern, "startingOffsets": starting, "rows": rows, "position": f"{checkpoint}-position/next"}
    return spark.readStream.format("topic_log").options(**options).schema(schema).load()
