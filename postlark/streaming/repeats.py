"""Which keys a stream has seen, as state that begins with those of the stored documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SLIM = "k1 bigint, k2 bigint, created_at timestamp, id bigint, file string"
_FIELDS = ["k1", "k2", "created_at", "id", "file"]
_HELD = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("until", "<i8")])
BUCKETS = 1 << 14
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """The earliest rows of a bucket's keys that are not known, after which these keys are known for a time.

    The state of a bucket is one value: its keys, each with the time until which it blocks. So calls and messages to the state
    follow the buckets that a batch touches, not its keys. A timer clears what has run out, and a row that comes before the
    timer has fired but after that time is let through all the same.
    """

    def __init__(self, horizon_ms: int, now_ms: int):
        self.horizon_ms, self.now_ms = horizon_ms, now_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = handle.getValueState("keys", "keys binary")

    def _held(self) -> np.ndarray:
        found = self.keys.get()
        return np.zeros(0, _HELD) if found is None else np.frombuffer(bytes(found[0]), _HELD)

    def _hold(self, held: np.ndarray, keys: list[tuple[int, int]], from_ms: int) -> None:
        """Add keys to what is held, with a timer for the first to run out where none is set."""
        added = np.array([(*key, from_ms + self.horizon_ms) for key in keys], _HELD)
        self.keys.update((np.concatenate([held, added]).tobytes(),))
        if not len(held) or from_ms + self.horizon_ms < held["until"].min():
            self.handle.registerTimer(from_ms + self.horizon_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        self._hold(self._held(), _keys(initialState), self.now_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = list(rows)  # of one bucket, and few for each key (``_first_of_each``)
        every = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        arrived = int(every["arrived_ms"].iloc[0])  # the same for all rows of a batch
        held = self._held()
        held = held[held["until"] > arrived]
        known = set(zip(held["k1"].tolist(), held["k2"].tolist()))
        order = list(zip(*[map(_nulls_last, every[c].tolist()) for c in ("created_at", "id", "file")]))
        first: dict[tuple[int, int], int] = {}
        for i, of_row in enumerate(_keys(every)):
            if of_row not in known and (of_row not in first or order[i] < order[first[of_row]]):
                first[of_row] = i
        if first:
            self._hold(held, list(first), arrived)
            yield every[_FIELDS].iloc[list(first.values())]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        left = held[held["until"] > expiredTimerInfo.getExpiryTimeInMs()]
        if len(left):
            self.keys.update((left.tobytes(),))
            self.handle.registerTimer(int(left["until"].min()))
        elif len(held):
            self.keys.clear()
        return iter(())

    def close(self) -> None:
        pass


def _nulls_last(value) -> tuple:
    return (True, 0) if value is None or value != value else (False, value)


def _keys(rows: pd.DataFrame) -> list[tuple[int, int]]:
    """The hashes of each row's key; null keys, which have a bucket of their own, are one key."""
    both = zip(rows["k1"].tolist(), rows["k2"].tolist())
    return [(0, 0) if a is None or a != a else (int(a), int(b)) for a, b in both]


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest row of each key among the rows of an Arrow batch, so that a hot key sends few rows on."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).sort_by([("created_at", "ascending"), ("id", "ascending"), ("file", "ascending")])
        places = rows.select(["k1", "k2"]).append_column("at", pa.array(range(len(rows)), pa.int64()))
        first = places.group_by(["k1", "k2"]).aggregate([("at", "min")])["at_min"]
        yield from rows.take(first).to_batches()


def _bucket() -> Column:
    return F.coalesce(F.pmod("k1", F.lit(BUCKETS)), F.lit(-1)).cast("int").alias("bucket")


def first_arrivals_by_state(slim: DataFrame, stored: DataFrame, horizon_ms: int, now_ms: int) -> DataFrame:
    """The slim rows (SLIM) of a stream whose key neither the stored keys nor an earlier batch had within the horizon; of a
    batch the earliest row of each key."""
    spark = slim.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    reduced = slim.select(*_FIELDS).mapInArrow(_first_of_each, SLIM).select("*", _bucket())
    timed = reduced.withColumn("arrived", F.current_timestamp()).withColumn("arrived_ms", F.unix_millis("arrived")).withWatermark(
        "arrived", "0 seconds")
    return timed.groupBy("bucket").transformWithStateInPandas(
        FirstOfKey(horizon_ms, now_ms), SLIM, "append", "EventTime", initialState=stored.select("*", _bucket()).groupBy("bucket"))
