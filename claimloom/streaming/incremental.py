"""Incremental corpora: what is new, what carries over, and a streaming file source merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key no finished row has."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def carry_forward(rows: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fills empty columns from an earlier table."""
    old = previous.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = rows.join(old, key, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")) for c in columns}).drop(*[f"_{c}" for c in columns])


def merge_new_files(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, key: list[str]) -> StreamingQuery:
    """Adds the rows of files that arrive in a folder to a Parquet table, each key once.

    Each batch is joined against what the table has; a batch that runs again adds nothing twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(key)
        session = batch.sparkSession
        try:
            fresh = fresh.join(session.read.parquet(target).select(*key), key, "left_anti")
        except Exception as error:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(error):
                raise
        fresh.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reassemble(deltas: DataFrame, key: str, order: str) -> DataFrame:
    """Streamed replies put together: contents in order of arrival and the last finish reason."""
    ordered = F.array_sort(F.collect_list(F.struct(order, "delta")))
    text = F.array_join(F.transform(ordered, lambda x: F.coalesce(x["delta"], F.lit(""))), "")
    return deltas.groupBy(key).agg(text.alias("text"), F.max_by("finish_reason", F.when(F.col("finish_reason").isNotNull(), F.col(order))).alias("finish_reason"))
