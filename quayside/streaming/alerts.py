"""Upward crossings over a stream of monitored values, with keyed state for groups of curve positions.

Values name the version of their position that they follow, so the stream itself tells what is still
missing. A value waits in its position's state until the one it follows has been judged, and is then
released together with all that wait behind it; late versions therefore change nothing in the result.
What leaves the state are steps (a value that rose over the last priced one), which each micro-batch
joins with the rules of that moment. Alerts are appended and never taken back, so they outlive
their rule.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quayside.errors import ConfigError
from quayside.operators.alerts import crossed_rules
from quayside.schemas import CROSSING, MONITORED, STEP, conform

KEY = ["curve_id", "position"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What the first value of a position follows.
START = -1
#: Groups of positions whose state is one value.
BUCKETS = 1024
#: What goes into the state, and the steps that leave it, dates as text.
FLAT = [*KEY, "follows", "dataset_version", "as_of", "priced", "price"]
FLAT_STEP = T.StructType([
    T.StructField(f.name, {"as_of": T.StringType(), "price": T.LongType(), "previous_price": T.LongType()}.get(f.name, f.dataType))
    for f in STEP.fields])


def with_follows(values: DataFrame) -> DataFrame:
    """Values (MONITORED) with `follows`, the version before it of the same position, null for its first.
    A publisher knows it when it writes a version; this derives it from a whole history."""
    before = Window.partitionBy(*KEY).orderBy("dataset_version")
    return values.withColumn("follows", F.lag("dataset_version").over(before))


def stream_monitored(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The append-only monitored values of all versions as a stream, with `follows`."""
    schema = T.StructType([*MONITORED.fields, T.StructField("follows", T.LongType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class Place:
    """What is kept of one curve position: the last version released, the last priced one before it with its
    price, the values that wait, by the version they follow, and when patience with them ends."""

    __slots__ = ("moved", "priced", "price", "waiting", "until")

    def __init__(self, moved: int = START, priced: int | None = None, price: int | None = None,
                 waiting: dict | None = None, until: int | None = None):
        self.moved, self.priced, self.price, self.waiting, self.until = moved, priced, price, waiting or {}, until

    def packed(self) -> tuple:
        return self.moved, self.priced, self.price, self.waiting, self.until

    def release(self) -> list[tuple]:
        """Go on as far as the waiting values reach: the rising steps on the way."""
        steps, start = [], self.moved
        while (value := self.waiting.pop(self.moved, None)) is not None and value[0] > self.moved:
            self.moved, as_of, now = value
            if now is not None:
                if self.price is not None and now > self.price:
                    steps.append((self.moved, as_of, now, self.price, self.priced))
                self.priced, self.price = self.moved, now
        if self.moved != start:
            self.waiting = {follows: value for follows, value in self.waiting.items() if value[0] > self.moved}
        return steps


class Sequencer(StatefulProcessor):
    """State of one bucket of curve positions: their places (`Place`), packed as one value that is read and
    written once per micro-batch, so the calls to the state do not grow with positions or values.
    `patience_ms` bounds the wait: when it is over the earliest waiting value of a position is released
    although what it follows never came."""

    def __init__(self, patience_ms: int | None):
        self.patience_ms = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("places", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        places, steps, touched = self._read(), [], set()
        for part in rows:
            columns = (part[c].tolist() for c in FLAT)
            for curve, position, follows, version, as_of, priced, price in zip(*columns):
                own = (curve, position)
                place = places.get(own)
                if place is None:
                    place = places[own] = Place()
                if version > place.moved:  # what was released before is not judged again
                    place.waiting[follows] = (version, as_of, price if priced else None)
                    touched.add(own)
        for own in touched:
            steps += [(*own, *step) for step in places[own].release()]
        yield from self._written(places, steps, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        places, steps, now = self._read(), [], timerValues.getCurrentProcessingTimeInMs()
        for own, place in places.items():
            if place.waiting and place.until is not None and place.until <= now:
                place.moved, place.until = min(place.waiting), None
                steps += [(*own, *step) for step in place.release()]
        yield from self._written(places, steps, timerValues)

    def _read(self) -> dict[tuple, Place]:
        held = self.state.get()
        return {} if held is None else {own: Place(*packed) for own, packed in pickle.loads(held[0]).items()}

    def _written(self, places: dict[tuple, Place], steps: list[tuple], timerValues) -> Iterator[pd.DataFrame]:
        if self.patience_ms is not None:
            self._wait(places, timerValues)
        self.state.update((pickle.dumps({own: place.packed() for own, place in places.items()}, protocol=5),))
        if steps:
            yield pd.DataFrame(steps, columns=[f.name for f in FLAT_STEP.fields])

    def _wait(self, places: dict[tuple, Place], timerValues) -> None:
        """One timer per bucket, for the position with which patience ends first."""
        end = timerValues.getCurrentProcessingTimeInMs() + self.patience_ms
        for place in places.values():
            place.until = None if not place.waiting else place.until or end
        first = min((p.until for p in places.values() if p.until is not None), default=None)
        timers = list(self.handle.listTimers())
        for at in timers:
            if at != first:
                self.handle.deleteTimer(at)
        if first is not None and first not in timers:
            self.handle.registerTimer(first)

    def close(self) -> None:
        pass


def steps_of(monitored: DataFrame, patience_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rising steps (`schemas.STEP`) of a stream of values, each once, in version order. Prices go
    through the state as whole numbers of their last place. `buckets` stays as it is for a checkpoint."""
    scale = STEP["price"].dataType.scale
    units = F.coalesce((F.col("price") * F.lit(10**scale)).cast("bigint"), F.lit(0))
    flat = monitored.select(
        F.pmod(F.xxhash64(*KEY), F.lit(buckets)).alias("bucket"), *KEY,
        F.coalesce("follows", F.lit(START)).cast("bigint").alias("follows"), "dataset_version",
        F.col("as_of_date").cast("string").alias("as_of"), F.col("price").isNotNull().alias("priced"), units.alias("price"))
    found = flat.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Sequencer(patience_ms), outputStructType=FLAT_STEP, outputMode="append",
        timeMode="none" if patience_ms is None else "processingTime")
    price = lambda c: (F.col(c).cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).alias(c)
    return conform(found.select(
        *KEY, "dataset_version", F.col("as_of").cast("date").alias("as_of"), price("price"), price("previous_price"),
        "previous_version"), STEP)


def run_crossings(
    monitored: DataFrame, rules: Callable[[], DataFrame], out: str, checkpoint: str,
    patience_ms: int | None = None, every: str | None = None,
) -> StreamingQuery:
    """Append below `out` the crossings of the rules that live when a step is released.

    The query ends when all that has landed is judged, or runs on with a micro-batch `every` so often. Only
    a query that runs on can lose patience with a version that does not come (`patience_ms`).

    `monitored` streams values with `follows`. A batch owns its two folders and rewrites them on a retry,
    so every crossing is there once, also after a restart from `checkpoint`.
    """
    if patience_ms is not None and every is None:
        raise ConfigError("patience needs a query that runs on: say how often it looks for values")
    monitored.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}

    def judge(batch: DataFrame, batch_id: int) -> None:
        # Written first: the state is run through once, however often the steps are read.
        batch.write.mode("overwrite").parquet(f"{out}/steps/batch={batch_id}")
        steps = batch.sparkSession.read.schema(STEP).parquet(f"{out}/steps/batch={batch_id}")
        crossed_rules(steps, rules()).write.mode("overwrite").parquet(f"{out}/crossings/batch={batch_id}")

    return (
        steps_of(monitored, patience_ms).writeStream.foreachBatch(judge).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read_crossings(spark: SparkSession, out: str) -> DataFrame:
    """All crossings (`schemas.CROSSING`) found so far, also while the query runs."""
    return conform(spark.read.schema(CROSSING).parquet(f"{out}/crossings"), CROSSING)
