"""The last click of every order as a join of two streams, without emitting a pair per click.

Orders and clicks of a customer-merchant pair meet in one stateful operator.
Its state holds the orders that still wait and the clicks that an order can
still take: those above the watermark, and the newest one below it. An order is
settled when the watermark passes it, as no earlier click can come any more; an
event-time timer does that for pairs that see no further events. So each order
leaves once, with its last click inside the window or without one, and the
state is bounded by what happens within the watermark's delay.

Pairs are dealt into a fixed number of hash buckets, and a bucket is the key of
the state: its pairs are settled together, in one pass over sorted arrays, and
its rows are one value of the state. The operator's cost per key, several calls
between the worker and the state store, is so paid per bucket and not per pair.

Replayed events are taken once: by their id while they are in the state, and as
late rows after that. Events without an id are never copies of each other.
Rows behind the watermark are dropped by the engine; ``ingest`` counts them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from adlift import schemas as S
from adlift.operators.attribution import PAIR
from adlift.session import use_disk_state
from adlift.streaming.ingest import write_batch

#: An order and its click, both as the event logs name them.
SETTLED = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_timestamp", T.TimestampType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("click_id", T.StringType()),
        T.StructField("click_timestamp", T.TimestampType()),
    ]
)
#: Kind of a row that carries nothing but event time, so that a quiet stream moves on.
HEARTBEAT = "heartbeat"
#: Keys of the state. More of them make each value smaller; a running stream cannot change their number.
BUCKETS = 1_024
_COLUMNS = ["kind", "event_id", "at"]
_STATE = pa.schema([(c, pa.int64() if c == "at" else pa.string()) for c in [*_COLUMNS, *PAIR]])


def _waiting(rows: pd.DataFrame, by: Sequence[str]) -> pd.DataFrame:
    """Events once each, by pair in order of time and id, clicks before the orders of their time."""
    pair = np.zeros(len(rows), np.int64)
    for c in by:
        own, names = pd.factorize(rows[c], use_na_sentinel=False)
        pair = pair * max(1, len(names)) + own
    rows = rows.assign(_pair=pair, _last=rows["kind"] == "order")
    known = rows["event_id"].notna()
    once = pd.concat([rows[known].drop_duplicates(["_pair", "kind", "event_id"]), rows[~known]])
    return once.sort_values(["_pair", "at", "_last", "event_id"], na_position="first").reset_index(drop=True)


def settle(
    rows: pd.DataFrame, watermark: int, window: int, by: Sequence[str] = ()
) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Orders at or below the watermark with their last click, and what has to wait on; times in microseconds.

    Orders take clicks with the same values of ``by``, of which nulls are one.
    """
    rows = _waiting(rows, by)
    ids, pair, at = rows["event_id"].to_numpy(object), rows["_pair"].to_numpy(), rows["at"].to_numpy(np.int64)
    order, click = (rows["kind"] == "order").to_numpy(), (rows["kind"] == "click").to_numpy()
    newest = np.maximum.accumulate(np.where(click, np.arange(len(rows)), -1))
    due = np.flatnonzero(order & (at <= watermark))
    last = newest[due]
    met = (last >= 0) & (pair[last] == pair[due]) & (at[due] - at[last] <= window)
    out = pd.DataFrame(
        {
            "order_id": ids[due],
            "order_at": at[due],
            "click_id": np.where(met, ids[last], None),
            "click_at": np.where(met, at[last], -1),
            **{c: rows[c].to_numpy(object)[due] for c in by},
        }
    )
    clicks = np.flatnonzero(click)
    above = at[clicks] > watermark
    # Of a pair's clicks below the watermark, the newest: none follows, or one above.
    end = np.append(above[1:] | (pair[clicks][1:] != pair[clicks][:-1]), True)[: len(clicks)]
    # A click that no order above the watermark can take is of no use.
    useful = clicks[(above | end) & (at[clicks] > watermark - window)]
    kept = np.sort(np.append(np.flatnonzero(order & (at > watermark)), useful))
    return out, rows.iloc[kept][[*_COLUMNS, *by]]


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _STATE) as writer:
        writer.write_table(pa.Table.from_pandas(rows, _STATE, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(value) as reader:
        return reader.read_pandas()


class LastClick(StatefulProcessor):
    """Settles the orders of one bucket of pairs; see the module."""

    def __init__(self, window_us: int):
        self.window = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", "rows binary, timer long")

    def _step(self, new: list[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        watermark = timer_values.getCurrentWatermarkInMs() * 1000
        timer, parts = None, list(new)
        value = self.state.get()
        if value is not None:
            packed, timer = value
            parts.insert(0, _unpacked(bytes(packed)))
        if not parts:
            return
        settled, rest = settle(pd.concat(parts, ignore_index=True), watermark, self.window, PAIR)
        if len(rest):
            # The timer settles the first order, or forgets the first click.
            first = int((rest["at"] + np.where(rest["kind"] == "order", 0, self.window)).min())
            due = first // 1000 + 1
            if timer is not None and timer != due:
                self.handle.deleteTimer(timer)
            if timer != due:
                self.handle.registerTimer(due)
            self.state.update((_packed(rest), due))
        elif value is not None:
            if timer > watermark // 1000:
                self.handle.deleteTimer(timer)
            self.state.clear()
        if len(settled):
            # As whole microseconds: pandas would take nullable ones through doubles.
            clicked = settled["click_at"].to_numpy("datetime64[us]").copy()
            clicked[settled["click_at"] == -1] = np.datetime64("NaT")
            yield pd.DataFrame(
                {
                    "order_id": settled["order_id"],
                    "order_timestamp": settled["order_at"].to_numpy("datetime64[us]"),
                    "customer_id": settled["customer_id"],
                    "merchant_id": settled["merchant_id"],
                    "click_id": settled["click_id"],
                    "click_timestamp": clicked,
                }
            )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._step([r[[*_COLUMNS, *PAIR]] for r in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._step([], timerValues)

    def close(self) -> None:
        pass


def settled_orders(
    touched: DataFrame, window_days: float = S.CLICK_WINDOW_DAYS, delay: str = S.WATERMARK, buckets: int = BUCKETS
) -> DataFrame:
    """A stream of touches (orders, clicks, heartbeats) as a stream of settled orders."""
    spark = touched.sparkSession
    use_disk_state(spark)
    # The process that asks for the state's layout sees no shipped files: the operator travels by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # Of the state only ids and times are kept; other columns are not even shuffled.
    bucket = F.pmod(F.xxhash64(*PAIR), F.lit(buckets)).alias("bucket")
    rows = touched.withWatermark("timestamp", delay).select(
        bucket, "kind", "event_id", *PAIR, F.unix_micros("timestamp").alias("at"), "timestamp"
    )
    window = int(timedelta(days=window_days) / timedelta(microseconds=1))
    return rows.groupBy("bucket").transformWithStateInPandas(LastClick(window), SETTLED, "Append", "EventTime")


def run_interval_join(touched: DataFrame, target: str, checkpoint: str, **options) -> list[dict]:
    """Settle all that has arrived, one folder per batch; returns the progress of each batch."""
    query = (
        settled_orders(touched, **options)
        .writeStream.foreachBatch(lambda batch, number: write_batch(batch, target, number) and None)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [dict(p) if isinstance(p, dict) else p for p in query.recentProgress]
