"""Streams: ingest, routing, defragmentation with an age limit, batching, idempotent callbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from scanloom.session import checkpoint_root

SHARD_SIZE = 5000


def _checkpoint(df: DataFrame, name: str) -> str:
    return f"{checkpoint_root(df.sparkSession)}/{name}"


def ingest(messages: DataFrame, target: str, name: str, **trigger) -> StreamingQuery:
    """Append a message stream to a table folder exactly once.

    A sender may be acknowledged once the batch that holds its file is committed.
    """
    return (messages.writeStream.format("parquet").option("checkpointLocation", _checkpoint(messages, name)).queryName(name)
            .trigger(**(trigger or {"availableNow": True})).start(target))


def each_batch(stream: DataFrame, name: str, write: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Run a batch writer per micro-batch; the writer gets the batch id to stay idempotent."""
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", _checkpoint(stream, name)).queryName(name)
            .trigger(**(trigger or {"availableNow": True})).start())


def _stateful(df: DataFrame) -> None:
    """State with timers and lists needs the RocksDB store; a running stream keeps the store it began with."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _millis(times: pd.Series) -> list[int]:
    return (times.astype("datetime64[ns]").astype("int64") // 1_000_000).tolist()


class EventBatcher(StatefulProcessor):
    """Open batch of one key: its events and its number live in state until it is full or old."""

    def __init__(self, size: int, max_wait_ms: int, forget_ms: int):
        self.size, self.wait, self.forget = size, max_wait_ms, max(forget_ms, max_wait_ms + 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "event string")
        self.head = handle.getValueState("head", "batch_no bigint, since bigint, n int")

    def closed(self, key, number: int, events: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"order_id": [key[0]], "retrieve_id": [key[1]], "shard": [key[2]], "batch_no": [number], "events": [events]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """Events in order of arrival time and id; what a batch holds does not depend on the micro-batches that brought it."""
        arrived = sorted((t, i, e) for part in rows for t, i, e in zip(_millis(part["received_at"]), part["event_id"], part["event"]))
        number, since, n = self.head.get() if self.head.exists() else (0, 0, 0)
        held = [e[0] for e in self.open.get()] if n else []
        was, kept = (number, since), len(held)
        for time, _, event in arrived:
            if held and (len(held) == self.size or time > since + self.wait):
                yield self.closed(key, number, held)
                number, held = number + 1, []
            since = time if not held else since
            held.append(event)
        if len(held) == self.size:
            yield self.closed(key, number, held)
            number, held = number + 1, []
        if number == was[0]:
            self.open.appendList([(e,) for e in held[kept:]])
        else:
            self.open.put([(e,) for e in held]) if held else self.open.clear()
        self.head.update((number, since, len(held)))
        if held and ((number, since) != was or not kept):
            self.handle.registerTimer(since + self.wait + 1)
        self.handle.registerTimer(since + self.forget)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.head.exists():
            return
        number, since, n = self.head.get()
        if n and expiredTimerInfo.getExpiryTimeInMs() > since + self.wait:
            yield self.closed(key, number, [e[0] for e in self.open.get()])
            self.open.clear()
            self.head.update((number + 1, since, 0))
        elif not n and expiredTimerInfo.getExpiryTimeInMs() >= since + self.forget:
            self.head.clear()

    def close(self) -> None:
        pass


def stream_batches(events: DataFrame, size: int = 100, max_wait_ms: int = 60_000, time: str = "received_at", delay: str = "1 minute", shards: int = 1, forget_ms: int = 30 * 86_400_000) -> DataFrame:
    """Batches of at most ``size`` events per order and retrieval: order_id, retrieve_id, shard, batch_no, events.

    ``events`` has order_id, retrieve_id, event (a struct with eventId) and an arrival time. A batch closes when it is full, when an event
    arrives more than ``max_wait_ms`` after its first, or when the watermark has passed that moment. Numbers go on from batch to
    batch of a key; ``forget_ms`` after its last batch began, a key without open events leaves the state and would start at 0 again. ``shards`` above 1 splits every key by a hash of the event id, for streams in which one key
    holds a large share of the events; numbers count within a shard then. ``events`` are JSON texts; an empty key part counts as a key.
    Arrival times may lie up to ``delay`` behind the latest one.
    """
    _stateful(events)
    keyed = events.select(
        F.coalesce("order_id", F.lit("")).alias("order_id"), F.coalesce("retrieve_id", F.lit("")).alias("retrieve_id"), F.pmod(F.xxhash64("event.eventId"), F.lit(shards)).cast("int").alias("shard"),
        F.col(time).cast("timestamp").alias("received_at"), F.coalesce("event.eventId", F.lit("")).alias("event_id"), F.to_json("event", {"ignoreNullFields": "false"}).alias("event"))
    return keyed.withWatermark("received_at", delay).groupBy("order_id", "retrieve_id", "shard").transformWithStateInPandas(
        EventBatcher(size, max_wait_ms, forget_ms), "order_id string, retrieve_id string, shard int, batch_no bigint, events array<string>", "append", "eventTime")


def batch_events(stream: DataFrame, name: str, target: str, size: int = 100, max_wait_ms: int = 60_000, time: str = "received_at", shards: int = 1, **trigger) -> StreamingQuery:
    """Append the closed batches of :func:`stream_batches` to a folder, with their event count and request body."""
    closed = stream_batches(stream, size, max_wait_ms, time, shards=shards)
    body = F.concat(F.lit('{"events":['), F.array_join("events", ","), F.lit("]}"))
    return ingest(closed.withColumns({"event_count": F.size("events"), "body": body}).drop("events"), target, name, **trigger)


def idempotent(events: DataFrame, time: str, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Drop repeated event ids that arrive within ``delay``; state older than that is released."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def with_final_state(instances: DataFrame, retrievals: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Stream-static join: instances see the final state of their retrieval, also a failed one."""
    keys = keys or ["order_id", "retrieve_id"]
    return instances.join(retrievals.select(*keys, F.col("status").alias("retrieve_status")), keys, "left")


SHARD_OUTPUT = "group string, shard int, shards int, fragment_count int, status string, arrived int, since bigint, until bigint"
FAILED_SHARDS = 64


class ShardCollector(StatefulProcessor):
    """Fragments of one shard of a group, until all have arrived or the first is too old.

    A finished shard leaves a mark that tells repeats and late fragments from a new group; the mark goes when
    the age has passed once more, so no state stays for ever."""

    def __init__(self, max_age_ms: int):
        self.age = max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "fragment_index int", "received_at bigint")
        self.head = handle.getValueState("head", "since bigint, until bigint, arrived int, status string")

    def row(self, key, status, arrived, since, until) -> pd.DataFrame:
        group, shard, shards, count = key
        return pd.DataFrame({"group": [group], "shard": [shard], "shards": [shards], "fragment_count": [count], "status": [status], "arrived": [arrived], "since": [since], "until": [until]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, shard, shards, count = key
        times: dict[int, int] = {}
        first, last, n = None, None, 0
        for part in rows:
            for index, time in zip(part["fragment_index"], _millis(part["received_at"])):
                first, last, n = time if first is None else min(first, time), time if last is None else max(last, time), n + 1
                if shard >= 0:
                    times[int(index)] = min(time, times.get(int(index), time))
        if shard < 0:  # no place in any group: nothing to wait for
            yield self.row(key, "failure", n, first, last)
            return
        since, until, arrived, status = self.head.get() if self.head.exists() else (first, last, 0, "open")
        if status == "expired":
            yield self.row(key, "late", len(times), since, max(until, last))
        if status != "open":
            return
        new = [i for i in times if not self.seen.containsKey((i,))]
        for i in new:
            self.seen.updateValue((i,), (times[i],))
        arrived, since, until = arrived + len(new), min(since, first), max(until, last)
        if arrived == (count - shard + shards - 1) // shards:
            self.seen.clear()
            self.head.update((since, until, arrived, "complete"))
            yield self.row(key, "complete", arrived, since, until)
        else:
            self.head.update((since, until, arrived, "open"))
        self.handle.registerTimer(max(since + self.age, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.head.exists():
            return
        since, until, arrived, status = self.head.get()
        if status == "open":
            self.seen.clear()
            self.head.update((since, until, arrived, "expired"))
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.age)
            yield self.row(key, "incomplete", arrived, since, until)
        elif expiredTimerInfo.getExpiryTimeInMs() >= since + self.age:
            self.head.clear()

    def close(self) -> None:
        pass


def defragment(fragments: DataFrame, max_age_ms: int, group: str = "fragment_identifier", time: str = "received_at", delay: str = "1 minute",
               shard_size: int = SHARD_SIZE) -> DataFrame:
    """Shard states of fragment groups: complete, incomplete after ``max_age_ms``, late, or failure.

    A group is cut by fragment index into shards of about ``shard_size`` fragments; the index range tells a
    shard how many to expect, so even a very large group never sits in one task's state. Rows carry the number of shards. Age is
    counted from the first arrival in arrival time, so a replay gives the same result. Fragments without group, index or count, or with an
    index outside of the count, are failures: they wait for nothing and leave no state. A fragment that arrives again counts once.
    :func:`group_states` folds the shard rows into one state per group.
    """
    _stateful(fragments)
    index, count = F.col("fragment_index"), F.col("fragment_count")
    valid = F.coalesce(F.col(group).isNotNull() & (index >= 0) & (index < count), F.lit(False))
    shards = F.when(valid, F.greatest(F.lit(1), F.ceil(count / shard_size).cast("int"))).otherwise(0)
    spread = -1 - F.pmod(F.xxhash64(group, "fragment_index", time), F.lit(FAILED_SHARDS)).cast("int")
    shard = F.when(valid, F.pmod(index, F.greatest(shards, F.lit(1)))).otherwise(spread)
    keyed = (fragments.withColumn("received_at", F.col(time).cast("timestamp")).withWatermark("received_at", delay)
             .select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group"), shard.cast("int").alias("shard"), shards.alias("shards"), F.coalesce(count, F.lit(-1)).cast("int").alias("fragment_count"),
                     F.coalesce(index, F.lit(-1)).cast("int").alias("fragment_index"), "received_at"))
    return keyed.groupBy("group", "shard", "shards", "fragment_count").transformWithStateInPandas(ShardCollector(max_age_ms), SHARD_OUTPUT, "append", "eventTime")


def group_states(shards: DataFrame, max_age_ms: int | None = None, as_of_ms: int | None = None) -> DataFrame:
    """COMPLETE when every shard is, within the age; ZIP_INCOMPLETE when a shard expired, the
    shards took longer than the age together, or ``as_of_ms`` lies beyond it; OPEN otherwise. Failures belong to no group."""
    out = shards.filter("status <> 'failure'").groupBy("group", "fragment_count").agg(
        F.max("shards").alias("_shards"),
        F.count_if(F.col("status") == "complete").alias("_done"), F.count_if(F.col("status") == "incomplete").alias("_expired"),
        F.min("since").alias("_since"), F.max(F.when(F.col("status") == "complete", F.col("until"))).alias("_until"),
        F.coalesce(F.sum(F.when(F.col("status") == "late", F.col("arrived"))), F.lit(0)).alias("late_fragments"))
    done, overdue = F.col("_done") == F.col("_shards"), F.col("_expired") > 0
    if max_age_ms is not None:
        overdue = overdue | F.coalesce(F.col("_until") - F.col("_since") > max_age_ms, F.lit(False))
        if as_of_ms is not None:
            overdue = overdue | (~done & (F.lit(as_of_ms) - F.col("_since") > max_age_ms))
    state = F.when(overdue, "ZIP_INCOMPLETE").when(done, "COMPLETE").otherwise("OPEN")
    return out.withColumn("state", state).drop("_shards", "_done", "_expired", "_since", "_until")
