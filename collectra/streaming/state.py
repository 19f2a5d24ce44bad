"""Last contact per client, kept across drops of the contact log.

The log only grows; what the call-centre detail needs of it is one row per
client.  A streaming aggregate keeps that row in Spark's state store and each
micro-batch touches the clients of its own drops only, instead of reading the
whole log again.  The clients that changed are written to the batch's own
partition, which a replayed batch replaces; as the largest (key, date, type,
note) wins, any order or split of the drops ends in the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collectra.operators.callcenter import base
from collectra.operators.cleaning import clean_contacts


def ingest_contacts(spark: SparkSession, landing_dir: str, schema: T.StructType, out_path: str, checkpoint: str,
                    order_col: str = "seq", files_per_batch: int = 1000) -> str:
    """Bring the state up to the contact drops (Parquet) landed in ``landing_dir`` so far."""
    stream = (spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "*.parquet")
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(landing_dir))

    def handle(changed: DataFrame, batch_id: int):
        (changed.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    q = (base.last_contacts(clean_contacts(stream), order_col).writeStream.outputMode("update")
         .foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def stored_last(spark: SparkSession, out_path: str) -> DataFrame:
    """(Cedula_Cliente, last): the state as of the last batch.  A client's rows of earlier batches are never larger."""
    return spark.read.parquet(out_path).groupBy("Cedula_Cliente").agg(F.max("last").alias("last"))


def join_stored_contact(detail: DataFrame, out_path: str) -> DataFrame:
    """:func:`base.join_latest_contact` from the state: the contact log is not read."""
    return base.with_latest(detail, base.of_last(stored_last(detail.sparkSession, out_path)))
