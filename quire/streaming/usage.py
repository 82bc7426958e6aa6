"""Structured Streaming: incremental ingestion, usage windows with late data, and the token limiter as a stateful operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arriving(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files as (path, modificationTime, length, content), for decoders."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).load(path)


def usage(calls: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Tokens and calls by method and event-time window; rows later than the watermark are left out by design."""
    return calls.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "method").agg(F.count("*").alias("calls"), F.sum("tokens").alias("tokens")).select("w.start", "method", "calls", "tokens")


def limited(calls: DataFrame, limit: int, window: int = 60) -> DataFrame:
    """calls (run, call, sec, tok): seconds each call waits, with the state of a run's limiter kept between batches.

    Calls of a run are taken in order within a batch; batches arrive in order."""

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, used, now = state.get if state.exists else (None, 0, None)
        rows = pd.concat(list(batches)).sort_values(["sec", "call"])
        out = []
        for call, sec, tok in zip(rows["call"], rows["sec"], rows["tok"]):
            now = max(sec if now is None else now, sec)
            if at is None or now - at >= window:
                at, used = now, 0
            if used and used + tok > limit:
                now, at, used = at + window, at + window, 0
            used += tok
            out.append((key[0], int(call), int(now - sec)))
        state.update((int(at), int(used), int(now)))
        yield pd.DataFrame(out, columns=["run", "call", "wait"])

    return calls.groupBy("run").applyInPandasWithState(step, "run bigint, call bigint, wait bigint", "at bigint, used bigint, now bigint", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all that is there, then stops; a rerun with the same checkpoint takes only what is new."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", path).start().awaitTermination()
