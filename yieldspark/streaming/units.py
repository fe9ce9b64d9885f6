"""First activity per unit as the state of a stream.

One value per (sn, model): its earliest production time so far. A batch is
first reduced to one row per unit, day and kind where it is read, so a unit
with very many rows sends few; the unit's state is then looked up and changed
in one task. What comes out are events: the days that the batch touches, and
the moves of first activities, -1 at the old time and +1 at the new one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C

EVENTS = "sn string, model string, day date, t long, sign int"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UNIT_DAY = ["sn", "model", "day", "prod"]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest time of each unit, day and kind of row in an Arrow batch."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(_UNIT_DAY).aggregate([("t", "min")])
        yield from t.rename_columns([*_UNIT_DAY, "t"] if t.column_names[0] == "sn" else ["t", *_UNIT_DAY]).select(
            [*_UNIT_DAY, "t"]).combine_chunks().to_batches()


class FirstSeen(StatefulProcessor):
    """State: the earliest production time (microseconds) of one unit."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        days, low = set(), None
        for r in rows:
            days.add(r.day)
            if r.prod and (low is None or r.t < low):
                low = r.t
        for d in sorted(days):  # bounded by the calendar
            yield Row(sn=key[0], model=key[1], day=d, t=None, sign=0)
        if low is None:
            return
        old = self.first.get()[0] if self.first.exists() else None
        if old is None or low < old:
            self.first.update((low,))
            if old is not None:
                yield Row(sn=key[0], model=key[1], day=None, t=old, sign=-1)
            yield Row(sn=key[0], model=key[1], day=None, t=low, sign=1)

    def close(self) -> None:
        pass


def unit_events(log: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Events of a log stream: touched days (sign 0) and moves (sign -1, +1)."""
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # the provider that keeps state of this kind
    rows = log.filter(F.col(C.END).isNotNull()).select(
        "sn", "model", C.to_day(C.END).alias("day"), F.coalesce(C.is_production(cfg=cfg), F.lit(False)).alias("prod"),
        F.unix_micros(F.col(C.END).cast("timestamp")).alias("t"))
    rows = rows.mapInArrow(_combine, "sn string, model string, day date, prod boolean, t long")
    return rows.groupBy("sn", "model").transformWithState(FirstSeen(), EVENTS, "update", "none")


def moves(events: DataFrame) -> DataFrame:
    """sn, model, first_activity_time, sign."""
    t = F.timestamp_micros("t").cast("timestamp_ntz").alias("first_activity_time")
    return events.where("sign <> 0").select("sn", "model", t, "sign")


def touched_days(events: DataFrame) -> DataFrame:
    return events.where("sign = 0").select("day").distinct()
