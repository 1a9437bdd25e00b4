"""Keyed state over streams: key states with conflicts, and started operations with timers.

Both run on Spark's keyed state (``transformWithState``): one small value per key, or per bucket of observations, in
the state store, which is checkpointed with the offsets, so nothing is read back from a target. The state store must
be the RocksDB one (``use_keyed_state``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from revtide.operators.history import KEY, OPERATION, STATE
from revtide.operators.telemetry import outcome_label

_STATE = "revision long, tombstone boolean, digest string"
_MERGED = f"kind string, id string, {_STATE}, status string"
_OUTCOME = "observation string, operation string, ts long, result string"
#: What an operations stream holds of a bucket: starts have no ``result``, finishes no ``operation``.
_HELD = pa.schema([("observation", pa.string()), ("operation", pa.string()), ("result", pa.string()), ("ts_s", pa.int64()), ("due", pa.int64())])


def use_keyed_state(spark: SparkSession) -> None:
    """The only state store that keyed state can use."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def _rows(frames: Iterator[pd.DataFrame], order: list[str]) -> list[dict]:
    """One key's rows of one micro-batch in order, NULLs as None."""
    whole = pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable")
    return [{k: None if pd.isna(v) else v for k, v in row.items()} for row in whole.to_dict("records")]


class _KeyStates(StatefulProcessor):
    def init(self, handle) -> None:
        self.state = handle.getValueState("state", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """A micro-batch is a page: its rows of the key are folded, then meet the stored state."""
        new, broken, before = None, False, None
        for row in _rows(rows, ["position"]):
            now = (int(row["revision"]), bool(row["tombstone"]), row["digest"])
            if before is not None and (now[0] < before[0] or (now[0] == before[0] and now[1:] != before[1:])):
                broken = True
            before = now
            if new is None or now[0] >= new[0]:
                new = now
        old = self.state.get() if self.state.exists() else None
        old = None if old is None else (int(old[0]), bool(old[1]), old[2])
        if broken or (old and (new[0] < old[0] or (new[0] == old[0] and new != old))):
            status, kept = "conflict", old
        elif old is None:
            status, kept = "inserted", new
        elif new == old:
            status, kept = "repeated", old
        else:
            status, kept = "advanced", new
        if status in ("inserted", "advanced"):
            self.state.update(kept)
        revision, tombstone, digest = kept or (None, None, None)
        yield pd.DataFrame(
            {
                "kind": [key[0]], "id": [key[1]], "revision": pd.array([revision], "Int64"),
                "tombstone": pd.array([tombstone], "boolean"), "digest": [digest], "status": [status],
            }
        )

    def close(self) -> None:
        pass


def key_state_stream(operations: DataFrame) -> DataFrame:
    """``merge_key_state`` over a stream of operations: every key of a micro-batch with its state and ``status``.

    ``conflict`` keeps the stored state (NULLs where there is none): the side output to act on. Otherwise
    ``inserted``, ``advanced`` or ``repeated``. Output mode is update.
    """
    rows = operations.select(*[c for c in OPERATION if c not in STATE], *STATE)
    return rows.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=_KeyStates(), outputStructType=_MERGED, outputMode="Update", timeMode="None"
    )


#: Observations of an operations stream are dealt to so many buckets, each with one value in the state store.
BUCKETS = 1024


class _Operations(StatefulProcessor):
    """One value per bucket: its open observations' first starts and the finishes seen, as compressed Arrow rows.

    Calls into the state store cost far more than the rows of an observation, so a bucket's observations share them.
    Every observation keeps to its own time: the bucket's timer is that of the next one due.
    """

    def __init__(self, timeout_s: int):
        self.timeout_s = timeout_s

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "rows binary, due long")

    def _stored(self) -> tuple[pd.DataFrame | None, int | None]:
        if not self.seen.exists():
            return None, None
        packed, due = self.seen.get()
        with pa.ipc.open_stream(packed) as stream:
            return stream.read_pandas(), int(due)

    def _keep(self, rows: pd.DataFrame, before: int | None) -> None:
        """Store the rows with a timer for the first observation due, which is ``before`` so far."""
        due = int(rows["due"].min()) if len(rows) else None
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)
        if due is None:
            self.seen.clear()
            return
        batch = pa.RecordBatch.from_pandas(rows, _HELD, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
        self.seen.update((sink.getvalue().to_pybytes(), due))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old, before = self._stored()
        own = ["observation", "operation", "result", "ts_s"]
        whole = pd.concat([f[own] for f in (old, *rows) if f is not None], ignore_index=True).astype({"ts_s": "int64"})
        begun = whole["result"].isna()
        starts = whole[begun].sort_values(["ts_s", "operation"], kind="stable").drop_duplicates("observation")
        finishes = whole[~begun].drop_duplicates(["observation", "ts_s", "result"])
        # A finish without a start is none; its state goes when a start can no longer come.
        lone = finishes[~finishes["observation"].isin(starts["observation"])]
        last = pd.concat([starts, lone]).groupby("observation", dropna=False)["ts_s"].max().rename("due")
        kept = pd.concat([starts, finishes]).merge(((last + self.timeout_s) * 1000 + 1).reset_index(), on="observation")
        self._keep(kept, before)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows, _ = self._stored()
        fired = int(expiredTimerInfo.getExpiryTimeInMs())
        over = rows["due"] <= max(fired, int(timerValues.getCurrentWatermarkInMs()) - 1)
        done, begun = rows[over], rows[over]["result"].isna()
        starts = done[begun].drop(columns="result").rename(columns={"ts_s": "ts"})
        ends = done[~begun][["observation", "ts_s", "result"]].merge(starts[["observation", "ts"]], on="observation")
        fits = ends[(ends["ts_s"] >= ends["ts"]) & (ends["ts_s"] - ends["ts"] <= self.timeout_s)]
        first = fits.sort_values(["ts_s", "result"]).drop_duplicates("observation")
        found = starts.merge(first[["observation", "result"]], on="observation", how="left")
        # The fired timer is gone with this call.
        self._keep(rows[~over], None)
        if len(found):
            yield found[["observation", "operation", "ts", "result"]].astype(object).where(lambda f: f.notna(), None).astype({"ts": "int64"})

    def close(self) -> None:
        pass


def abandoned_operations_stream(starts: DataFrame, finishes: DataFrame, timeout_s: int, late: str = "1 minute") -> DataFrame:
    """``abandoned_operations`` over streams: every started observation once, when its time has passed.

    ``starts``: ``observation, operation, ts``; ``finishes``: ``observation, result, ts``, with ``ts`` a timestamp.
    Repeated starts and finishes are tolerated: the first start and the first finish from it on count. An
    observation's state is dropped at the first watermark past start and ``timeout_s``; rows
    later than ``late`` are dropped by the watermark. Observations are kept by bucket, so a micro-batch reads and
    writes the open observations of the buckets that it has rows of.
    """
    nothing = F.lit(None).cast("string")
    begun = starts.select("observation", "operation", nothing.alias("result"), "ts")
    ended = finishes.select("observation", nothing.alias("operation"), F.coalesce("result", F.lit("")).alias("result"), "ts")
    rows = begun.unionByName(ended).withColumn("ts_s", F.unix_timestamp("ts")).withWatermark("ts", late)
    rows = rows.withColumn("observation", F.col("observation").cast("string"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("observation"), F.lit(BUCKETS)))
    out = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Operations(timeout_s), outputStructType=_OUTCOME, outputMode="Append", timeMode="EventTime"
    )
    outcome = F.when(F.col("result").isNull(), "abandoned").otherwise(outcome_label(F.col("result")))
    return out.select("observation", "operation", "ts", outcome.alias("outcome"))
