"""Publishing events as keyed JSON records (any key/value sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..sources.records import event_json


def keyed_records(events: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, value): the event as JSON (nulls written), keyed by the user.

    Key-partitioned sinks place records by the key themselves, which keeps one
    user's events in order on one shard; the DataFrame is therefore not
    repartitioned by key here (a hot user would otherwise land in one task).
    """
    return events.select(F.col(key).cast("string").alias("key"), event_json(events).alias("value"))


def publish(records: DataFrame, fmt: str, options: dict[str, str] | None = None,
            path: str | None = None, mode: str = "append") -> dict[str, int]:
    """Write (key, value) records with any batch sink (kafka, json, parquet ...) and
    return how many were sent and how many could not be (a record without a value). A failed
    task fails the write, and Spark retries it; it doesn't count its records twice."""
    obs = Observation()
    counted = records.observe(obs, F.count_if(F.col("value").isNotNull()).alias("sent"),
                              F.count_if(F.col("value").isNull()).alias("failed"))
    w = counted.where(F.col("value").isNotNull()).write.format(fmt).mode(mode) \
        .options(**(options or {}))
    if path is None:
        w.save()
    else:
        w.save(path)
    return {k: int(v) for k, v in obs.get.items()}
