"""I02 as a stream: every attempt counts once, however often it is delivered and wherever a run is broken off."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.common import ship

RESULT = "site string, tries long, record_id string, at timestamp"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Attempts(StatefulProcessor):
    """Remembers a site's attempts (time and record) for ``keep`` after they were made; a timer forgets them. Rows go out for what is new."""

    def __init__(self, keep_ms: int) -> None:
        self.keep = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "at long, record_id string", "n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, first = [], not self.seen.exists()
        for frame in rows:
            for at, record in zip(frame["at"].astype("datetime64[us]").astype("int64").tolist(), frame["record_id"].tolist()):
                # a record id may be missing; the empty text stands for it here
                mark = (at, record if isinstance(record, str) else "")
                if not self.seen.containsKey(mark):
                    self.seen.updateValue(mark, (1,))
                    new.append(mark)
        if new:
            if first:
                self.handle.registerTimer(min(new)[0] // 1000 + self.keep)
            at, record = max(new)
            yield pd.DataFrame({"site": [key[0]], "tries": [len(new)], "record_id": [record or None], "at": [pd.Timestamp(at, unit="us")]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        marks = list(self.seen.keys())
        for mark in marks:
            if mark[0] // 1000 + self.keep <= now:
                self.seen.removeKey(tuple(mark))
        left = [m[0] for m in marks if m[0] // 1000 + self.keep > now]
        if left:
            self.handle.registerTimer(min(left) // 1000 + self.keep)
        yield from ()

    def close(self) -> None:
        pass


def new_attempts(events: DataFrame, late: str = "1 hour", keep_hours: float = 24) -> DataFrame:
    """(site, at, record_id) -> site, tries, record_id, at for each batch: the attempts that it adds, and their last. An attempt that comes
    again within ``keep_hours`` of its time adds nothing; one behind the watermark (``late``) is dropped, so keep at least as long. State
    holds the attempts of that time only."""
    spark = events.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    rows = events.where("site IS NOT NULL AND at IS NOT NULL").select("site", F.col("at").cast("timestamp").alias("at"), "record_id")
    return rows.withWatermark("at", late).groupBy("site").transformWithStateInPandas(Attempts(int(keep_hours * 3_600_000)), RESULT, "Update", "EventTime")


def write_attempts(attempts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Each batch goes to a folder of its number, which a batch that runs again replaces: no attempt is added twice."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return attempts.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_attempts(spark: SparkSession, target: str, since: int = -1) -> DataFrame:
    """site, at, record_id, tries, batch of the batches after ``since``, for ``merge_attempts``; older folders are not read. The last batch
    that was merged is the next ``since``."""
    schema = f"{RESULT}, batch long"
    try:
        found = spark.read.schema(schema).parquet(target)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], schema)
    return found.where(F.col("batch") > since)
