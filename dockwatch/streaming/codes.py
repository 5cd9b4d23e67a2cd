"""Station codes carried as keyed state of a stream: the last code seen per station fills the messages that lost theirs.

The state is kept by Spark's state store and survives restarts with the checkpoint; it can start from a stored table and drop stations that
have not been heard of for some time. The session must use the RocksDB store (``STORE``), which this operator needs. Unlike
``live.carry_code``, which keeps a snapshot of all codes per micro-batch, a batch touches only the stations it holds.
"""

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
STATE = "station_code string, seen long"


class LastCode(StatefulProcessor):
    """State of a station: its last code and the time of the reading it came from, in microseconds."""

    def __init__(self, expire: timedelta = None):
        self.expire_ms = None if expire is None else int(expire.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE, self.expire_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for code, seen in zip(initialState["station_code"], initialState["seen"]):
            self.last.update((code, int(seen)))

    def handleInputRows(self, key, rows, timerValues):
        """Rows with a code pass at once; those without wait for the end of the batch, whose own codes count too."""
        held = self.last.get() if self.last.exists() else None
        before = None if held is None else (int(held[1]), held[0])
        newest, lost = before, []
        for frame in rows:
            without = frame["station_code"].isna()
            coded = frame[~without]
            if len(coded):
                newest = max(([newest] if newest else []) + [max(zip(coded["seen"].astype("int64"), coded["station_code"]))])
                yield coded
            if without.any():
                lost.append(frame[without])
        if newest != before:
            self.last.update((newest[1], int(newest[0])))
        for frame in lost:
            yield frame.assign(station_code=None if newest is None else newest[1])

    def close(self) -> None:
        pass


def carry_code_stream(rows: DataFrame, time: str = "collected_at", initial: DataFrame = None, expire: timedelta = None) -> DataFrame:
    """Fill lost codes of streaming ``rows`` (``station_id, station_code`` and more) with the last code up to and with their micro-batch.

    The last code is the one of the latest ``time``, of equal times the greatest, so a late message changes nothing. ``initial`` holds
    ``station_id, station_code, seen_at`` of an earlier run; ``expire`` drops a station's code that long after it changed last.
    A row without a station id passes as it is. With ``expire`` the stream keeps running batches to drop old state: use an interval as trigger,
    not ``availableNow``, which would never end.
    """
    seen = F.unix_micros(F.col(time).cast("timestamp"))
    timed = rows.withColumn("seen", F.coalesce(seen, F.lit(-(1 << 62))))
    known = timed.filter(F.col("station_id").isNotNull())
    state = None
    if initial is not None:
        state = initial.select("station_id", "station_code", F.unix_micros(F.col("seen_at").cast("timestamp")).alias("seen"))
        state = state.filter("station_id IS NOT NULL AND station_code IS NOT NULL").groupBy("station_id")
    filled = known.groupBy("station_id").transformWithStateInPandas(
        LastCode(expire), known.schema, "append", "none" if expire is None else "processingTime", state)
    return filled.unionByName(timed.filter(F.col("station_id").isNull())).drop("seen")
