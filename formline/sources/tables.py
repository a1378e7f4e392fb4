"""Feature tables laid out by entity, so that later stages need no shuffle by it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

# Buckets of a table; tables that are joined by entity share the number.
BUCKETS = 200


def write_by_entity(df: DataFrame, path: str, entity: str = "PLAYER_ID", order: Sequence[str] = ("GAME_DATE", "GAME_ID"), buckets: int = BUCKETS,
                    table: str | None = None) -> DataFrame:
    """Write a Parquet table bucketed by entity and sorted inside, one file a bucket, and return it as read from the catalog.

    Windows, aggregates and joins by entity take the buckets as they are: their plans hold no exchange by it, and
    two tables with the same number of buckets join where they lie. The table's name is in the session's catalog
    (a new one unless given), its files are under ``path``. An entity's rows share a bucket; where one entity
    holds more rows than a task should sort, the operators cut it into blocks as they do for any table.
    """
    spark, name = df.sparkSession, table or f"formline_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, entity)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, entity).sortBy(entity, *order).saveAsTable(name)
    return spark.table(name)
