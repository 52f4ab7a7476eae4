"""Velocity features of a stream: keyed state per card, as `operators.velocity` computes them over a bounded frame.

A card's state is a ring of (second, rows, cents) over the last 24 hours of its event time, packed into one value, and its newest
transaction. A micro-batch touches the cards it holds and nothing else. The ring forgets what is older than 24 hours with
each row, and an event-time timer empties it when the card falls silent; the newest transaction stays, so that a gap of any length
is known. A ring has at most 86,401 entries of 24 bytes, however often a card is used.

Python runs here, on Arrow batches per card, as keyed state with timers has no expression of its own. The state comes and goes
with the rows (`applyInPandasWithState`), so any state store will do, also Spark's default one.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txguard.functions import time as TM
from txguard.operators.velocity import ROLLING

WIDEST = max(ROLLING.values())
STATE = "ring binary, sec bigint, cents bigint"
MADE = "secs_since_prev bigint, amt_ratio_prev double, " + ", ".join(
    f"tx_count_{k} bigint, amt_sum_{k} double" for k in ROLLING
)


def add_to_ring(ring: np.ndarray, secs: np.ndarray, cents: np.ndarray) -> np.ndarray:
    """Rows of a ring (seconds, counts, cents) with those of new transactions added, ascending."""
    new = np.stack([secs, np.ones_like(secs), cents])
    every = np.concatenate([ring, new], axis=1)
    at, place = np.unique(every[0], return_inverse=True)
    out = np.zeros((3, len(at)), dtype=np.int64)
    out[0] = at
    np.add.at(out[1], place, every[1])
    np.add.at(out[2], place, every[2])
    return out


def rolling(ring: np.ndarray, secs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and cents from `width` seconds before each second up to and including it."""
    first = np.searchsorted(ring[0], secs - width, side="left")
    last = np.searchsorted(ring[0], secs, side="right")
    counts = np.concatenate([[0], np.cumsum(ring[1])])
    sums = np.concatenate([[0], np.cumsum(ring[2])])
    return counts[last] - counts[first], sums[last] - sums[first]


class OneCard:
    """A card's grouped state as the value and the timer that `Velocity` asks for."""

    def __init__(self, state: GroupState):
        self.state, self.due = state, None

    def getValueState(self, name: str, schema: str) -> "OneCard":
        return self

    def exists(self) -> bool:
        return self.state.exists

    def get(self) -> tuple:
        return self.state.get

    def update(self, value: tuple) -> None:
        self.state.update(value)

    def listTimers(self) -> list[int]:
        return []  # a group has one timer, which the next one replaces

    def registerTimer(self, at: int) -> None:
        self.due = at


def _per_card(kept: list[str]):
    """`Velocity` over the rows of a card in a micro-batch, or over its timer."""

    def run(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        card, processor = OneCard(state), Velocity(kept)
        processor.init(card)
        if not state.hasTimedOut:
            yield from processor.handleInputRows(key, rows, None)
            if card.due > state.getCurrentWatermarkMs():
                state.setTimeoutTimestamp(card.due)
                return
        yield from processor.handleExpiredTimer(key, None, None)

    return run


class Velocity:
    def __init__(self, kept: list[str]):
        self.kept = kept

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("card", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["second", "trans_num", "cents"], na_position="first", kind="stable", ignore_index=True)
        ring, newest, cents = np.zeros((3, 0), dtype=np.int64), None, None
        if self.state.exists():
            packed, newest, cents = self.state.get()
            ring = np.frombuffer(packed, dtype=np.int64).reshape(3, -1)
        secs = batch["second"].to_numpy(dtype=np.int64)
        own = batch["cents"].astype("Float64").to_numpy(dtype=float, na_value=np.nan)
        ring = add_to_ring(ring, secs, np.nan_to_num(own).astype(np.int64))

        before = np.concatenate([[np.nan if cents is None else cents], own[:-1]])
        gap = np.concatenate([[0], np.diff(secs)]).astype(float)
        gap[0] = np.nan if newest is None else secs[0] - newest
        if newest is not None and secs[0] < newest:  # came late: what was before it is no longer known
            gap[0], before[0] = np.nan, np.nan
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(before == 0, np.nan, (own / 100) / (before / 100))
        out = {c: batch[c] for c in self.kept}
        out["secs_since_prev"] = pd.array([None if np.isnan(g) else int(g) for g in gap], dtype="Int64")
        out["amt_ratio_prev"] = pd.array([None if np.isnan(r) else r for r in ratio], dtype="Float64")
        for k, width in ROLLING.items():
            n, s = rolling(ring, secs, width)
            out[f"tx_count_{k}"], out[f"amt_sum_{k}"] = n, s / 100

        if newest is None or secs[-1] >= newest:
            newest, cents = int(secs[-1]), None if np.isnan(own[-1]) else int(own[-1])
        self._keep(np.ascontiguousarray(ring[:, ring[0] >= newest - WIDEST]), newest, cents)
        yield pd.DataFrame(out)

    def _keep(self, ring: np.ndarray, newest: int, cents: int | None) -> None:
        self.state.update((ring.tobytes(), newest, cents))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((newest + WIDEST + 1) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            _, newest, cents = self.state.get()
            self.state.update((b"", newest, cents))
        return iter([])

    def close(self) -> None:
        pass


def stream_velocity(stream: DataFrame, kept: tuple[str, ...] = ("cc_num", "trans_num"), late: str = "24 hours") -> DataFrame:
    """`kept` columns and the features of `with_velocity` of each row of a stream (cc_num, trans_num, unix_time, amt, event_ts).

    On input that is ordered between micro-batches the features are those of the bounded frame. Rows of one second in two
    micro-batches see what had come by then. A late row gets the totals up to its own second, and no previous transaction if a
    later one was seen before; rows later than `late` are dropped by the engine, so choose it beyond any delay that
    occurs. Rows without card or time get nulls. All rows of a card in a micro-batch are one group.
    """
    rows = stream.withWatermark("event_ts", late).withColumn("second", TM.epoch_seconds())
    rows = rows.withColumn("cents", (F.col("amt").cast("decimal(14,2)") * 100).cast("bigint"))
    known = F.col("cc_num").isNotNull() & F.col("second").isNotNull()
    kinds = dict(rows.dtypes)
    schema = T.StructType.fromDDL(", ".join([f"`{c}` {kinds[c]}" for c in kept] + [MADE]))
    needed = list(dict.fromkeys([*kept, "cc_num", "trans_num", "second", "cents", "event_ts"]))
    found = rows.where(known).select(*needed).groupBy("cc_num").applyInPandasWithState(
        _per_card(list(kept)), schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[len(kept):]]
    return found.union(rows.where(~known | F.col("cc_num").isNull()).select(*kept, *nothing))
