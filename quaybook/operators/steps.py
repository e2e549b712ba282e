"""Transitions of the operators that go through a market's events in order, without Spark.

Batch and streaming run the same functions.
"""

from __future__ import annotations

import json
from dataclasses import astuple, dataclass, field
from decimal import Decimal
from operator import itemgetter

import numpy as np

ACCEPTED = "accepted"


@dataclass
class Sequence:
    """What the sequence rules remember of a market."""

    last: int | None = None
    awaiting: bool = False
    baseline_pending: bool = False
    last_time: int | None = None
    requested: bool = False

    def step(self, kind: str, sequence: int | None, jump: int, time: int) -> tuple[str, bool, bool]:
        """(accepted or why not, whether to request a snapshot, whether to reset the book)."""
        verdict, request, reset = self._judge(kind, sequence, jump, time)
        if verdict == ACCEPTED:
            self.last_time = time
        return verdict, request, reset

    def _judge(self, kind: str, sequence: int | None, jump: int, time: int) -> tuple[str, bool, bool]:
        if sequence is None:
            if self.last_time is not None and time < self.last_time:
                return "out_of_order", False, False
            self.baseline_pending, self.awaiting, self.requested = True, False, False
            return ACCEPTED, False, False
        if kind == "snapshot":
            if self.last is not None and sequence <= self.last:
                return "stale_or_duplicate", False, False
            self.last, self.awaiting, self.requested = sequence, False, False
            return ACCEPTED, False, False
        if self.baseline_pending:
            self.last, self.baseline_pending, self.requested = sequence, False, False
            return ACCEPTED, False, False
        if self.last is None:
            request, self.requested = not self.requested, True
            return "no_baseline", request, False
        if self.awaiting:
            return "awaiting_snapshot", False, False
        if sequence == self.last + jump:
            self.last = sequence
            return ACCEPTED, False, False
        if sequence <= self.last:
            return "stale_or_duplicate", False, False
        request, self.requested, self.awaiting = not self.requested, True, True
        return "sequence_gap", request, True

    @classmethod
    def guessed(cls, kind: str, sequence: int | None, jump: int | None, time: int | None) -> Sequence:
        """What a part of a market's order most likely finds, by its first event: a sequence that this goes on with."""
        return cls() if sequence is None or kind == "snapshot" else cls(last=sequence - (jump or 0), last_time=time)

    def passing(self, top: int | None, top_snapshot: int | None, top_free: int | None, least_jump: int | None) -> Sequence | None:
        """What comes out of a part that accepts nothing from this state; None if it may accept something.

        Of the part: the largest sequence number, that of snapshots, the latest time of events without number,
        and the least jump of updates, None where there are none.
        """
        updates = least_jump is not None
        if top_free is not None and (self.last_time is None or top_free >= self.last_time):
            return None
        if self.last is None:
            if top_snapshot is not None or (updates and self.baseline_pending):
                return None
            return Sequence(requested=self.requested or updates) if not self.baseline_pending else self
        if self.baseline_pending and updates:
            return None
        if updates and least_jump <= 0 and not self.awaiting:  # the last number again may be the next
            return None
        highest = top_snapshot if self.awaiting or self.baseline_pending else top
        return self if highest is None or highest <= self.last else None


@dataclass
class Part:
    """A walk through a part of a market's order, and what there could move a state."""

    state: Sequence
    entry: tuple = ()
    top: int | None = None
    top_snapshot: int | None = None
    top_free: int | None = None
    least_jump: int | None = None

    def __post_init__(self) -> None:
        self.entry = astuple(self.state)

    def step(self, kind: str, sequence: int | None, jump: int, time: int) -> None:
        if sequence is None:
            self.top_free = time if self.top_free is None else max(self.top_free, time)
        else:
            self.top = sequence if self.top is None else max(self.top, sequence)
            if kind == "snapshot":
                self.top_snapshot = sequence if self.top_snapshot is None else max(self.top_snapshot, sequence)
            else:
                self.least_jump = jump or 0 if self.least_jump is None else min(self.least_jump, jump or 0)
        self.state.step(kind, sequence, jump, time)


@dataclass
class Book:
    """A market's levels: of each price the quantity and the event that set it."""

    asks: dict[str, list[str]] = field(default_factory=dict)
    bids: dict[str, list[str]] = field(default_factory=dict)
    _told: dict[tuple[str, str], tuple[Decimal, list[str], str]] = field(default_factory=dict, repr=False, compare=False)

    def step(self, kind: str, event_id: str, asks: list[tuple[str, str]] | None, bids: list[tuple[str, str]] | None) -> None:
        """Canonical (price, quantity) levels; None says nothing about the side. A quantity of zero removes the level."""
        for side, levels in ((self.asks, asks), (self.bids, bids)):
            if kind == "reset" or (kind == "snapshot" and levels is not None):
                side.clear()
            for price, quantity in levels or ():
                if quantity == "0":
                    side.pop(price, None)
                else:
                    side[price] = [quantity, event_id]

    def sides(self) -> tuple[list[tuple[str, str, str]], list[tuple[str, str, str]]]:
        """(price, quantity, event) of asks by rising and of bids by falling price."""
        asks, bids = (sorted(((p, *v) for p, v in side.items()), key=lambda x: Decimal(x[0])) for side in (self.asks, self.bids))
        return asks, bids[::-1]

    def texts(self) -> tuple[str, str]:
        """sides() as JSON: a level gets its place in the order and its text once, not in each book that it lasts."""
        return self._text("asks"), self._text("bids")

    def views(self, events: list[tuple[str, str, list[tuple[str, str]] | None, list[tuple[str, str]] | None]]) -> list[tuple[list[dict], np.ndarray, np.ndarray]]:
        """step() for each of some events. Of asks and of bids: all levels that there are, in order, how many of them hold after each event, and their places among all, one event's after another's.

        A level gets its place in the order once and stands once, not in each book that it lasts.
        """
        sides = (self.asks, self.bids)
        known = [list(side.items()) for side in sides]
        holds = [{price: i for i, price in enumerate(side)} for side in sides]
        at, size = ([], []), ([], [])
        for kind, event_id, *levels in events:
            self.step(kind, event_id, *levels)
            for i, side in enumerate(sides):
                if kind == "reset" or (kind == "snapshot" and levels[i] is not None):
                    holds[i].clear()
                for price, _ in levels[i] or ():
                    level = side.get(price)
                    if level is None:
                        holds[i].pop(price, None)
                    elif price not in holds[i] or known[i][holds[i][price]][1] is not level:
                        holds[i][price] = len(known[i])
                        known[i].append((price, level))
                at[i].extend(holds[i].values())
                size[i].append(len(holds[i]))
        out = []
        for i in range(2):
            order = sorted(range(len(known[i])), key=lambda n, of=known[i]: Decimal(of[n][0]), reverse=i == 1)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            places = rank[np.array(at[i], np.int64)]
            places = places[np.lexsort((places, np.repeat(np.arange(len(events)), size[i])))]
            levels = [{"price": price, "quantity": quantity, "source_id": source} for price, (quantity, source) in map(known[i].__getitem__, order)]
            out.append((levels, np.array(size[i], np.int32), places))
        return out

    def _text(self, side: str) -> str:
        levels = []
        for price, level in getattr(self, side).items():
            told = self._told.get((side, price))
            if told is None or told[1] is not level:
                told = self._told[side, price] = (Decimal(price), level, json.dumps({"price": price, "quantity": level[0], "source_id": level[1]}))
            levels.append(told)
        levels.sort(key=itemgetter(0), reverse=side == "bids")
        return f"[{', '.join([text for _, _, text in levels])}]"


@dataclass
class Union:
    """A pair's side: what each exchange's latest book has. Exchanges are text, as keys of JSON are.

    A level gets its place in the order once, when its book comes, not in each view that it lasts.
    """

    held: dict[str, dict] = field(default_factory=dict)
    _placed: dict[tuple[str, int], list[tuple[tuple, dict]]] = field(default_factory=dict, repr=False, compare=False)

    def step(self, exchange: str, time: int, levels: list[dict]) -> None:
        self.held[exchange] = {"time": time, "levels": levels}
        for sign in (1, -1):
            self._placed.pop((exchange, sign), None)

    def _of(self, exchange: str, sign: int) -> list[tuple[tuple, dict]]:
        found = self._placed.get((exchange, sign))
        if found is None:
            found = [((sign * Decimal(x["price"]), -Decimal(x["quantity"]), x["exchange_id"]), x) for x in self.held[exchange]["levels"]]
            found.sort(key=itemgetter(0))
            self._placed[exchange, sign] = found
        return found

    def view(self, side: str) -> tuple[int, str]:
        """(latest time of the books, all levels as JSON) by price from the best, then falling quantity, then exchange."""
        sign = 1 if side == "asks" else -1
        levels = [x for exchange in self.held for x in self._of(exchange, sign)]
        levels.sort(key=itemgetter(0))  # of runs in order
        return max(book["time"] for book in self.held.values()), json.dumps([level for _, level in levels])

    def views(self, side: str, books: list[tuple[str, int, list[dict]]]) -> tuple[list[dict], list[tuple[int, np.ndarray]]]:
        """step() and view() for each of some books: all levels that there are, in order, and after each book the time and the places of those that hold.

        A level's place among them is found once, so a view is a few numbers put in order, and a level stands once for all views.
        """
        sign = 1 if side == "asks" else -1
        known: list[tuple[tuple, dict]] = []

        def placed(exchange: str) -> slice:
            begin = len(known)
            known.extend(self._of(exchange, sign))
            return slice(begin, len(known))

        runs, times, came = {e: placed(e) for e in self.held}, {e: book["time"] for e, book in self.held.items()}, []
        for exchange, time, levels in books:
            self.step(exchange, time, levels)
            came.append(placed(exchange))
        order = sorted(range(len(known)), key=lambda i: known[i][0])
        rank = np.empty(len(known), np.int32)
        rank[order] = np.arange(len(known), dtype=np.int32)
        runs, views = {e: rank[run] for e, run in runs.items()}, []
        for (exchange, time, _), run in zip(books, came, strict=True):
            runs[exchange], times[exchange] = rank[run], time
            views.append((max(times.values()), np.sort(np.concatenate(list(runs.values())))))
        return [known[i][1] for i in order], views


@dataclass
class Staleness:
    """What the monitor remembers of a topic."""

    since: int | None = None
    last_eval: int | None = None
    episodes: int = 0
    stale_time: int = 0

    def step(self, stale: bool, now: int) -> tuple[int, int, int] | None:
        """(since, recovered, duration) of an episode that ends now."""
        closed = None
        if self.since is not None and self.last_eval is not None:
            self.stale_time += now - self.last_eval
        if stale and self.since is None:
            self.since = now
            self.episodes += 1
        elif not stale and self.since is not None:
            closed = (self.since, now, now - self.since)
            self.since = None
        self.last_eval = now
        return closed
