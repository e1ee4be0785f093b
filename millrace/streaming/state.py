"""What the state stores of a stopped or running query hold, from its checkpoint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator: id, name, partitions and the batches it has."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator_name"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    ).distinct()


def state_rows(
    spark: SparkSession, checkpoint: str, operator_id: int, batch_id: int | None = None
) -> DataFrame:
    """Keys and values of one operator after a batch, the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    return (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)


def state_sizes(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Per operator: keys, bytes of keys and values as JSON text, and the keys of the
    fullest partition. Each store is read by its own task; a plan has few operators.
    """
    operators = state_operators(spark, checkpoint)

    def size(operator_id: int) -> DataFrame:
        rows = state_rows(spark, checkpoint, operator_id, batch_id)
        text = F.octet_length(F.to_json(F.struct("key", "value")))
        per_store = rows.groupBy("partition_id").agg(
            F.count("*").alias("keys"), F.sum(text).alias("bytes")
        )
        return per_store.agg(
            F.lit(operator_id).cast("long").alias("operator_id"),
            F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.max("keys"), F.lit(0)).alias("most_keys"),
        )

    found = [size(row["operator_id"]) for row in operators.collect()]
    if not found:
        return operators.selectExpr("*", "0L AS keys", "0L AS bytes", "0L AS most_keys")
    return operators.join(reduce(DataFrame.unionByName, found), "operator_id", "left")
