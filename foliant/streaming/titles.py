"""The first row of each title over the whole life of a stream, in order of arrival.

Titles are keyed state: a title's first row sets it, every later one finds it. Which row
of a micro-batch counts as first is told by an order column, so the outcome does not hang on
how rows are spread over tasks. Before the shuffle every task gives up all rows of a title
but the least: they are known to be later ones, need no state, and travel under keys of their
own, so that a hot title costs its group one row per task.

State is kept by RocksDB, on disk and in the query's checkpoint: it is as large as the
distinct titles, never read as a whole, and a restart or a batch that is run again finds it as it was. A
time to live bounds it where titles may come back after a while.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # State with a time to live would otherwise ask for batches without data for ever.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# What is known of a row before the state is asked.
OPEN, LATER, UNKEYED = range(3)
# Titles a task holds while it looks for their least rows, and keys that settled rows are dealt to.
HELD, LANES = 50_000, 64
ROW = "title_key string, lane int, place string, known int, row string"


@contextmanager
def state_on_disk(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _least_per_task():
    """Rows of a task with the later ones of each title marked. Travels by value."""
    held_most, lanes, later, unkeyed = HELD, LANES, LATER, UNKEYED

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[str, str]] = {}
        n = 0
        columns = ["title_key", "lane", "place", "known", "row"]

        def opened():
            return pd.DataFrame([(k, 0, place, 0, row) for k, (place, row) in held.items()], columns=columns)

        for frame in frames:
            out = []
            for key, place, row in zip(frame["title_key"], frame["place"], frame["row"]):
                n += 1
                if key is None:
                    out.append((None, n % lanes, place, unkeyed, row))
                    continue
                if key in held:
                    least, other = sorted((held[key], (place, row)))
                    held[key] = least
                    out.append((None, n % lanes, other[0], later, other[1]))
                else:
                    held[key] = (place, row)
            if out:
                yield pd.DataFrame(out, columns=columns)
            if len(held) > held_most:
                yield opened()
                held.clear()
        if held:
            yield opened()

    return mark


def _first_ever(ttl_ms: int | None):
    """The state of one title. Travels by value."""
    later, unkeyed = LATER, UNKEYED

    class FirstEver(StatefulProcessor):
        def init(self, handle) -> None:
            self.first = handle.getValueState("first", "place string", ttlDurationMs=ttl_ms)

        def handleInputRows(self, key, rows, timerValues):
            frame = pd.concat(list(rows), ignore_index=True)
            if key[0] is None:
                yield pd.DataFrame({"row": frame["row"], "is_first": [None if k == unkeyed else False for k in frame["known"]]})
                return
            least = min(zip(frame["place"], frame["row"], frame.index))
            new = not self.first.exists()
            if new:
                self.first.update((least[0],))
            yield pd.DataFrame({"row": frame["row"], "is_first": [new and i == least[2] for i in frame.index]})

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.first.update(("",))

        def close(self) -> None:
            pass

    return FirstEver()


def flag_first_titles(rows: DataFrame, order: str, known: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """The rows of a stream with ``is_first``: whether their ``title_key`` had not come before.

    ``order`` is a whole number or a text that sorts rows of one micro-batch; NULL comes last,
    and equal ones are told apart by the rows' values. Rows without a title key get NULL. ``known`` lists
    title keys taken from the start; it is read by the first batch of a new query only. With ``ttl_ms`` a title is
    forgotten that long (processing time) after its first row. Rows travel as JSON text.
    Start the query within ``state_on_disk``.
    """
    kind = rows.schema[order].dataType.simpleString()
    place = F.col(order).cast("string")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        # Shifted, so that texts of equal length sort as the numbers do.
        place = F.lpad((F.col(order).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    elif kind != "string":
        raise ValueError(f"cannot order titles by {order}, a {kind}")
    # A mark before the text puts NULL last.
    place = F.coalesce(F.concat(F.lit("0"), place), F.lit("1"))
    packed = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    narrow = rows.select("title_key", place.alias("place"), packed.alias("row"))
    settled = (
        narrow.mapInPandas(_least_per_task(), ROW)
        .groupBy("title_key", "lane")
        .transformWithStateInPandas(
            statefulProcessor=_first_ever(ttl_ms),
            outputStructType="row string, is_first boolean",
            outputMode="Append",
            timeMode="ProcessingTime" if ttl_ms else "None",
            initialState=None if known is None else _seeds(known),
        )
    )
    schema = rows.schema.simpleString()
    return settled.select(F.from_json("row", schema).alias("row"), "is_first").select("row.*", "is_first")


def _seeds(known: DataFrame):
    keys = known.select("title_key").where(F.col("title_key").isNotNull()).distinct()
    return keys.withColumn("lane", F.lit(0)).groupBy("title_key", "lane")
