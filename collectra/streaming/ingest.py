"""Pick up newly landed report files with Structured Streaming.

The file source remembers processed files in its checkpoint, so each landed
file is processed at least once and never twice after success;
``foreachBatch`` runs the batch pipeline, and its output is written per
``batch_id`` partition with dynamic overwrite, so a batch re-run after an
executor or driver failure replaces its own output instead of duplicating
it.  ``trigger(availableNow=True)`` drains what has landed and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collectra.session import fresh_path


def ingest_new_drops(spark: SparkSession, landing_dir: str, schema: T.StructType,
                     run_batch: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                     glob: str = "*.parquet", fmt: str = "parquet", files_per_batch: int = 1000) -> str:
    """Process every file landed in ``landing_dir`` not yet seen by ``checkpoint``,
    up to ``files_per_batch`` of them in one micro-batch (the rest in the next)."""
    stream = (spark.readStream.format(fmt).schema(schema)
              .option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
              .load(landing_dir))

    def handle(batch: DataFrame, batch_id: int):
        result = run_batch(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def ingest_call_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed call logs (the events table: a file, or a folder of files) -> per-centre call attempts."""
    from collectra.operators.callcenter import calls as cl
    from collectra.operators.cleaning import clean_calls
    from collectra.sources.fixtures import calls_from_events, table

    schema = table(spark, sf_dir, "events").schema

    def run_batch(batch: DataFrame) -> DataFrame:
        scoped = cl.call_scope(clean_calls(calls_from_events(batch)))
        return scoped.groupBy(F.col("Call_Center_Limpio").alias("Call_Center")).agg(
            F.count(F.lit(1)).alias("Total_Intentos"),
            F.count_if(F.col("Estado_Llamada") == "ANSWERED").alias("Con_Respuesta"))

    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    landing, glob = (path.toString(), "*.parquet") if folder else (sf_dir, "events.parquet")
    out = ingest_new_drops(spark, landing, schema, run_batch, fresh_path(spark, "ingest", "out"),
                           fresh_path(spark, "ingest", "ckpt"), glob=glob)
    return (spark.read.parquet(out).groupBy("Call_Center")
            .agg(F.sum("Total_Intentos").alias("Total_Intentos"), F.sum("Con_Respuesta").alias("Con_Respuesta")))


DROP_SCHEMA = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("landing", T.StringType()),
                            T.StructField("file_name", T.StringType()), T.StructField("size", T.LongType()),
                            T.StructField("empresa", T.StringType())])


def ingest_report_drops(spark: SparkSession, drops_dir: str, root: str, checkpoint: str, as_of,
                        promises_as_of=None, empresa: str = "", files_per_batch: int = 1000, **kw) -> int:
    """Run the report pipeline once for every report announced in ``drops_dir``.

    Each landed report announces itself with a small JSON manifest
    (``job_id``, ``landing`` folder with the five sheets, original
    ``file_name`` and ``size``).  Manifests failing the drop rule (name,
    extension) are recorded under ``<root>/rejected_drops``; a report of any
    size is taken.  A report whose pipeline fails is recorded with its errors
    under ``<root>/failed_drops`` and the others go on; announce it again to
    retry it (outputs are keyed by ``job_id``, so nothing is duplicated).
    Manifests come to the driver one partition at a time; the data work is
    distributed.  Returns the number of reports processed.
    """
    from collectra.plans.pipeline import run_landed_report
    from collectra.sources.store import drop_reason

    done = 0
    stream = (spark.readStream.schema(DROP_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
              .json(drops_dir))

    def record(rows: DataFrame, name: str, batch_id: int):
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/{name}"))

    def handle(batch: DataFrame, batch_id: int):
        nonlocal done
        checked = batch.withColumn("reason", drop_reason(F.col("file_name")))
        record(checked.where(F.col("reason").isNotNull()), "rejected_drops", batch_id)
        failed = []
        for r in checked.where(F.col("reason").isNull()).toLocalIterator():
            try:
                errors = run_landed_report(spark, r.landing, root, r.job_id, r.empresa or empresa, as_of,
                                           promises_as_of, **kw)["errors"]
            except Exception as e:  # noqa: BLE001  (an unreadable report must not stop the others)
                errors = {"report": str(e)[:500]}
            if errors:
                failed.append((r.job_id, r.landing, [f"{k}: {v}" for k, v in sorted(errors.items())]))
            else:
                done += 1
        record(spark.createDataFrame(failed, "job_id string, landing string, errors array<string>"), "failed_drops", batch_id)

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return done
