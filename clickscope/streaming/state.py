"""What a stream keeps: read from its checkpoint by the state data source.

A running aggregate needs no second store: the state store has it, the
checkpoint versions it with the offsets, and a replayed micro-batch leaves it
as it was. Readers get the state as of the last finished micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The provider that keyed processors need.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def state_rows(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """``(key, value, partition_id)`` of a query's state; ``variable`` names one of a stateful processor."""
    reader = spark.read.format("statestore")
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def running_state(spark: SparkSession, checkpoints: str | list[str], value: str = "clicks") -> DataFrame:
    """The grouping columns and the running count of a streaming count.

    Counts of several checkpoints add up: a new checkpoint starts from zero and reads
    what arrives after the earlier ones.
    """
    out = None
    paths = [checkpoints] if isinstance(checkpoints, str) else list(checkpoints)
    for path in paths:
        rows = state_rows(spark, path)
        rows = rows.select("key.*", F.col("value")[rows.schema["value"].dataType.names[0]].alias(value))
        out = rows if out is None else out.unionByName(rows)
    if len(paths) == 1:
        return out
    keys = [c for c in out.columns if c != value]
    return out.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def combined(rows: DataFrame, keys: list[str], value: str = "clicks") -> DataFrame:
    """``rows`` counted by ``keys`` within each Arrow batch, without a shuffle: a hot key
    sends one row a batch to the operator behind, not one for each click."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            yield from found.rename_columns([*keys, value]).to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    return rows.select(*keys).mapInArrow(run, f"{kinds}, `{value}` bigint")


# ---------------------------------------------------------------- the feedback loop

USER_STATE = "banned boolean, clicks array<struct<dt:string,adid:string,clicks:bigint>>"


class BannedUsers(StatefulProcessor):
    """Counts a user's clicks by day and ad until one count reaches ``threshold``.

    The user is then banned: the clicks of later micro-batches are dropped
    before they are counted, those of the same one still count. State: one value for each user (the
    counts, and whether the user is banned), so a user costs one read and
    one write a micro-batch. Emits a user once, when banned.
    """

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.user = handle.getValueState("user", USER_STATE)

    def _load(self):
        got = self.user.get()
        if got is None:
            return False, {}
        return bool(got[0]), {(c[0], c[1]): c[2] for c in got[1] or ()}

    def _store(self, banned: bool, clicks: dict) -> None:
        self.user.update((banned, [(dt, ad, n) for (dt, ad), n in clicks.items()]))

    def handleInputRows(self, key, rows, timerValues):
        banned, clicks = self._load()
        if banned:
            return
        for r in rows:
            at = (r.dt, r.adid)
            clicks[at] = clicks.get(at, 0) + r.clicks
        banned = max(clicks.values(), default=0) >= self.threshold
        self._store(banned, clicks)
        if banned:
            yield Row(userid=key[0])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        banned, clicks = self._load()
        for c in initialState.clicks or ():
            at = (c["dt"], c["adid"])
            clicks[at] = clicks.get(at, 0) + c["clicks"]
        self._store(banned or bool(initialState.banned), clicks)

    def close(self) -> None:
        pass


def users(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(userid, banned, clicks)`` of the feedback loop's state: an initial state for a new checkpoint."""
    return state_rows(spark, checkpoint, "user").select("key.userid", "value.banned", "value.clicks")


def banned_users(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(userid)`` on the blacklist."""
    return users(spark, checkpoint).where("banned").select("userid")


def user_clicks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(dt, adid, userid, clicks)``: the clicks that were counted."""
    return users(spark, checkpoint).select("userid", F.explode("clicks").alias("c")).select("c.dt", "c.adid", "userid", "c.clicks")
