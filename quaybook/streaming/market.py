"""The stateful operators on streams: sequence rules, books, unions and staleness, with state in RocksDB.

Stateless operators (parsing, rebasing, precision) take streams as they are. Here a
micro-batch's events of a key are put in order, then stepped through as in batch. State is
typed: a value for what the rules and the monitor remember, a map for books and unions, of which a
micro-batch writes only the levels, or the exchanges, that it has changed. Events travel through
Python as JSON, so that large numbers and nulls stay what they are, and in blocks of neighbours, a line for each:
what a row costs on its way to a state and back, a block costs once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import astuple
from itertools import islice
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StringType, StructType

from quaybook.functions import exact
from quaybook.functions.ids import minted
from quaybook.operators import book, validate
from quaybook.operators.steps import Book, Sequence, Staleness, Union
from quaybook.schema import EXCHANGE_BOOK, OWNED_LEVEL

MARKET = ["exchange_id", "pair_id"]
#: Rows that go back to Spark at once: each may hold a whole book.
FRAME_ROWS = 200
#: Events of a block and, about, its characters; and characters of blocks that go back to Spark at once.
BLOCK_ROWS, BLOCK_CHARS, FRAME_CHARS = 200, 1 << 20, 1 << 22
#: Books or views that go back to Spark together, with each of their levels once.
VIEW_ROWS = 64
#: What a book has of its event besides place, id and levels.
HEAD = {"simulation": "int", "event_time": "bigint", "sequence_id": "bigint"}
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Steps(StatefulProcessor):
    """A key's events of a micro-batch in order, between reading its state and writing what has changed."""

    columns: list[str]

    def load(self) -> None:
        raise NotImplementedError

    def rows(self, key: tuple, at: int, event: str, brief: str) -> Iterator[tuple]:
        """What comes of the event at a place, of which `brief` is what is read here."""
        raise NotImplementedError

    def save(self) -> None:
        raise NotImplementedError

    def made(self, key: tuple, events: list[tuple[int, str, str]]) -> Iterator[pd.DataFrame]:
        return self.framed(key, (row for at, text, brief in events for row in self.rows(key, at, text, brief)))

    def framed(self, key: tuple, made: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while part := list(islice(made, FRAME_ROWS)):
            yield pd.DataFrame(part, columns=self.columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = []  # the trigger's limits bound them
        for pdf in rows:
            for ords, texts, briefs in zip(*(pdf[c].tolist() for c in ("ord", "event", "brief")), strict=True):
                events.extend(zip(map(int, ords.split("\n")), texts.split("\n"), briefs.split("\n"), strict=True))
        events.sort(key=itemgetter(0))
        self.load()
        yield from self.made(key, events)
        self.save()

    def close(self) -> None:
        pass


class _Verdicts(_Steps):
    """Verdicts go back in blocks, too: the key once, `event` and `told` as texts with a line for each event, the other columns as arrays."""

    def __init__(self, kept: list[str]) -> None:
        #: What of `brief` goes back with the event.
        self.kept = kept
        self.columns = [*MARKET, "_ord", *kept, "event", "told"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("rules", "last long, awaiting boolean, baseline_pending boolean, last_time long, requested boolean")

    def load(self) -> None:
        self.rules = Sequence(*self.known.get()) if self.known.exists() else Sequence()

    def rows(self, key: tuple, at: int, event: str, brief: str) -> Iterator[tuple]:
        e = json.loads(brief)
        verdict, request, reset = self.rules.step(e["type"], e.get("sequence_id"), e.get("sequence_jump"), e.get("event_time"))
        yield at, *map(e.get, self.kept), event, f"{request:d}{reset:d}{verdict}"

    def framed(self, key: tuple, made: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        blocks, part, size, chars = [], [], 0, 0

        def block() -> tuple:
            *arrays, event, told = zip(*part, strict=True)
            return (*key, *map(list, arrays), "\n".join(event), "\n".join(told))

        for row in made:
            part.append(row)
            size += len(row[-2])
            if len(part) >= BLOCK_ROWS or size >= BLOCK_CHARS:
                blocks.append(block())
                chars += size
                part, size = [], 0
            if chars >= FRAME_CHARS:
                yield pd.DataFrame(blocks, columns=self.columns)
                blocks, chars = [], 0
        if part:
            blocks.append(block())
        if blocks:
            yield pd.DataFrame(blocks, columns=self.columns)

    def save(self) -> None:
        self.known.update(astuple(self.rules))


class _ViewSteps(_Steps):
    """Books or views go back some together: their levels once, in order, and of each how many of the places in `at` are its own."""

    def block(self, key: tuple, events: list[tuple[int, dict]]) -> tuple[tuple, int]:
        """Of some events the row that goes back, and about its size."""
        raise NotImplementedError

    def made(self, key: tuple, events: list[tuple[int, str, str]]) -> Iterator[pd.DataFrame]:
        blocks, chars = [], 0
        for i in range(0, len(events), VIEW_ROWS):
            row, size = self.block(key, [(at, json.loads(brief)) for at, _, brief in events[i : i + VIEW_ROWS]])
            blocks.append(row)
            chars += size
            if chars >= FRAME_CHARS:
                yield pd.DataFrame(blocks, columns=self.columns)
                blocks, chars = [], 0
        if blocks:
            yield pd.DataFrame(blocks, columns=self.columns)


def _begins(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size, dtype=np.int32) - size


class _Books(_ViewSteps):
    columns = ["exchange_id", "pair_id", "ord", "id", *HEAD, *(f"{s}{c}" for s in book.SIDES for c in ("", "_at", "_begin", "_size"))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side string, price string", "quantity string, event string")

    def load(self) -> None:
        self.book = Book()
        for (side, price), level in self.levels.iterator():
            getattr(self.book, side)[price] = list(level)
        self.before = {s: dict(getattr(self.book, s)) for s in ("asks", "bids")}

    def block(self, key: tuple, events: list[tuple[int, dict]]) -> tuple[tuple, int]:
        told = [(e["type"], e["id"], *(None if e.get(s) is None else [(x["p"], x["q"]) for x in e[s]] for s in book.SIDES)) for _, e in events]
        sides, chars = [], 0
        for levels, size, at in self.book.views(told):
            sides += [json.dumps(levels), at, _begins(size), size]
            chars += len(sides[-4]) + 4 * len(at)
        return (*key, [at for at, _ in events], [e["id"] for _, e in events], *([e.get(c) for _, e in events] for c in HEAD), *sides), chars

    def save(self) -> None:
        for side, before in self.before.items():
            now = getattr(self.book, side)
            for price in before.keys() - now.keys():
                self.levels.removeKey((side, price))
            for price, level in now.items():
                if before.get(price) != level:
                    self.levels.updateValue((side, price), tuple(level))


class _Unions(_ViewSteps):
    columns = ["pair_id", "side", "ord", "snapshot_id", "event_time", "levels", "at", "begin", "size"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", "exchange string", "time long, levels string")

    def load(self) -> None:
        self.union = Union({exchange: {"time": time, "levels": json.loads(levels)} for (exchange,), (time, levels) in self.held.iterator()})
        self.stepped: set[str] = set()

    def block(self, key: tuple, events: list[tuple[int, dict]]) -> tuple[tuple, int]:
        books = [e for _, e in events]
        self.stepped.update(str(e["exchange_id"]) for e in books)
        known, views = self.union.views(key[1], [(str(e["exchange_id"]), e["event_time"], e["levels"]) for e in books])
        size = np.array([len(at) for _, at in views], np.int32)
        levels = json.dumps(known)
        return (*key, [e["ord"] for e in books], [e["snapshot_id"] for e in books], [time for time, _ in views], levels, np.concatenate([at for _, at in views]), _begins(size), size), len(levels)

    def save(self) -> None:
        for exchange in self.stepped:
            now = self.union.held[exchange]
            self.held.updateValue((exchange,), (now["time"], json.dumps(now["levels"])))


class _Episodes(_Steps):
    columns = ["topic", "since", "recovered", "duration"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("seen", "since long, last_eval long, episodes long, stale_time long")

    def load(self) -> None:
        self.seen = Staleness(*self.known.get()) if self.known.exists() else Staleness()

    def rows(self, key: tuple, at: int, event: str, brief: str) -> Iterator[tuple]:
        e = json.loads(brief)
        if (episode := self.seen.step(bool(e["stale"]), e["now"])) is not None:
            yield *key, *episode

    def save(self) -> None:
        self.known.update(astuple(self.seen))


def on_rocks(spark: SparkSession) -> None:
    """Typed state and timers need RocksDB as the store of this session's next queries."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Neighbours of a key as one row, each of the other columns as text with a line for each of them."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cut = np.zeros(n, bool)
        cut[::BLOCK_ROWS] = True
        for k in keys:
            of = batch.column(k)
            cut[1:] |= pc.fill_null(pc.not_equal(of.slice(1), of.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        lines = {c: batch.column(c).cast(pa.string()) for c in ("ord", "event", "brief")}
        size = np.cumsum(sum(pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in lines.values())) // BLOCK_CHARS
        cut[1:] |= size[1:] != size[:-1]
        starts = np.flatnonzero(cut)
        ends = pa.array(np.append(starts, n), pa.int32())
        joined = [pc.binary_join(pa.ListArray.from_arrays(ends, x), "\n") for x in lines.values()]
        yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(starts)) for k in keys), *joined], [*keys, *lines])


def _stepped(events: DataFrame, brief: Column, order: str, steps: _Steps, schema: str, keys: list[str] = MARKET, event: Column | None = None) -> DataFrame:
    """events through steps, which read `brief`; `event` goes with it as it is."""
    on_rocks(events.sparkSession)
    packed = events.select(*keys, F.col(order).cast("long").alias("ord"), F.lit("").alias("event") if event is None else F.to_json(event).alias("event"), F.to_json(brief).alias("brief"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema if f.name in keys)
    blocks = packed.mapInArrow(lambda b: _blocks(b, keys), f"{types}, ord string, event string, brief string")
    return blocks.groupBy(*keys).transformWithStateInPandas(steps, schema, "append", "none")


def verdicts(events: DataFrame, order: str = "ord") -> DataFrame:
    """operators.validate.verdicts() on a stream. Each of an event's columns goes to the state and back once: as key, as place, as what the rules read, or with the rest as JSON."""
    types = {f.name: f.dataType for f in events.schema}
    ruled = ["type", "sequence_id", "sequence_jump", "event_time"]
    kept = [c for c in ruled if isinstance(types[c], IntegralType | StringType)]
    apart = {*MARKET, *kept, *([order] if isinstance(types[order], IntegralType) else [])}
    rest = [c for c in events.columns if c not in apart] or events.columns
    back = [*(f"{c} {types[c].simpleString()}" for c in MARKET), "_ord array<bigint>", *(f"{c} array<{types[c].simpleString()}>" for c in kept), "event string", "told string"]
    blocks = _stepped(events, F.struct(*ruled), order, _Verdicts(kept), ", ".join(back), event=F.struct(*rest))
    lines = [F.split(c, "\n").alias(c) for c in ("event", "told")]
    out = blocks.select(*MARKET, "_ord", *kept, *lines).select(*MARKET, F.inline(F.arrays_zip("_ord", *kept, "event", "told")))
    told = [F.substring("told", 3, 1 << 20).alias("verdict"), *((F.substring("told", i, 1) == "1").alias(c) for i, c in ((1, "request"), (2, "reset")))]
    read = out.select(*MARKET, *kept, F.col("_ord").cast(types[order]).alias("_ord"), F.from_json("event", StructType([events.schema[c] for c in rest])).alias("_rest"), *told)

    def whole(c: str) -> Column:
        return F.col(f"_rest.{c}") if c in rest else F.col(c) if c in (*MARKET, *kept) else F.col("_ord").alias(c)

    return read.select(*map(whole, events.columns), "verdict", "request", "reset")


def _held(known: Column, at: str, begin: Column, size: Column) -> Column:
    """A book's or view's own levels."""
    return F.transform(F.slice(at, begin + 1, size), lambda i: F.get(known, i))


def books(events: DataFrame, order: str = "ord") -> DataFrame:
    """operators.book.books() on a stream: a snapshot after every event."""

    def plain(side: str) -> Column:
        return F.transform(side, lambda x: F.struct(exact.canonical(x["price"]).alias("p"), exact.canonical(x["quantity"]).alias("q"))).alias(side)

    brief = F.struct("type", "id", *(F.col(c).cast(t).alias(c) for c, t in HEAD.items()), *map(plain, book.SIDES))
    schema = ", ".join(["exchange_id int", "pair_id int", "ord array<long>", "id array<string>", *(f"{c} array<{t}>" for c, t in HEAD.items()), *(f"{s} string, {s}_at array<int>, {s}_begin array<int>, {s}_size array<int>" for s in book.SIDES)])
    out = _stepped(events, brief, order, _Books(), schema)
    each = ["ord", "id", *HEAD]

    def told(asks: Column, bids: Column) -> Column:
        def one(x: Column) -> Column:
            return F.struct(*(x[c].alias(c) for c in each), *(_held(known, f"{s}_at", x[f"{s}_begin"], x[f"{s}_size"]).alias(s) for s, known in zip(book.SIDES, (asks, bids), strict=True)))

        return F.transform(F.arrays_zip(*each, *(f"{s}_{c}" for s in book.SIDES for c in ("begin", "size"))), one)

    asks, bids = (F.from_json(s, f"array<{OWNED_LEVEL}>") for s in book.SIDES)
    read = out.select("exchange_id", "pair_id", F.inline(exact.let(asks, lambda a: exact.let(bids, lambda b: told(a, b)))))
    return read.select(
        "exchange_id", "pair_id", "ord", "simulation", minted("book", F.col("id")).alias("id"), F.col("id").alias("trigger_id"), "event_time", F.col("sequence_id").alias("last_sequence_id"), "asks", "bids",
    )


def unioned(exchange_books: DataFrame) -> DataFrame:
    """operators.aggregate.unioned() on a stream of operators.book.split(); merged() needs no state and takes its output."""

    brief = F.struct("exchange_id", "ord", "snapshot_id", "event_time", "levels")
    schema = "pair_id int, side string, ord array<long>, snapshot_id array<string>, event_time array<long>, levels string, at array<int>, begin array<int>, size array<int>"
    out = _stepped(exchange_books, brief, "ord", _Unions(), schema, ["pair_id", "side"])

    def views(known: Column) -> Column:
        def view(x: Column) -> Column:
            return F.struct(x["ord"].alias("ord"), x["snapshot_id"].alias("snapshot_id"), x["event_time"].alias("event_time"), _held(known, "at", x["begin"], x["size"]).alias("levels"))

        return F.transform(F.arrays_zip("ord", "snapshot_id", "event_time", "begin", "size"), view)

    # few pairs, few tasks: what is costly, the levels of each view, is done by all
    spread = out.repartition(exchange_books.sparkSession.sparkContext.defaultParallelism)
    rows = spread.select("pair_id", "side", F.inline(exact.let(F.from_json("levels", f"array<{EXCHANGE_BOOK}>"), views)))
    return rows.select("pair_id", "side", "ord", minted("aggregate", F.col("side"), F.col("snapshot_id")).alias("id"), "event_time", "levels")


def episodes(polls: DataFrame) -> DataFrame:
    """Stale episodes of (topic, now, stale), as they end; one that is still open is in the state alone."""

    return _stepped(polls, F.struct("now", "stale"), "now", _Episodes(), "topic string, since long, recovered long, duration long", ["topic"])


def chained(events: DataFrame, order: str = "ord") -> DataFrame:
    """Sequence rules, books and unions in one query: three stateful steps, one behind another in each micro-batch.

    What a step gives of a micro-batch reaches the next one in the same, so a pair's records stay in
    order as long as micro-batches take its events by order, of all exchanges alike: read them from
    one topic for each pair.
    """
    return unioned(book.split(books(validate.accepted(verdicts(events, order)), order)))
