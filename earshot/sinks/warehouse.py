"""Loading a table into a relational warehouse through JDBC.

Spark's JDBC writer opens one connection per task, so the number of partitions
bounds the warehouse's concurrent inserts; ``max_connections`` coalesces to it
(a narrow step, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                mode: str = "append", max_connections: int | None = None,
                batch_size: int = 10000) -> int:
    """Write ``df`` to ``table`` with ``mode`` honoured; returns the rows written."""
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if max_connections:
        out = out.coalesce(int(max_connections))
    props = {"batchsize": str(batch_size), **(properties or {})}
    out.write.jdbc(url=url, table=table, mode=mode, properties=props)
    return int(obs.get["rows"])
