"""Structured Streaming form of the inference job (H-1).

The inference chain is stateless per listing, so it runs unchanged on every
micro-batch.  Fitted statistics (the demand score's min/max, or a fitted
PipelineModel) come from a static reference frame, so each batch is scored
against the same fit.  ``foreachBatch`` writes each batch's report with an
idempotent per-batch path, and the checkpoint location makes the query
restartable after a driver or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateweave.operators import clean, features, report, select
from rateweave.plans import jobs


def score_batch(batch: DataFrame, reference: DataFrame | None, elasticity: float = -1.2, model=None) -> DataFrame:
    """H-1 on one batch: demand from a fitted ``model``, or the demand target with
    its statistics fitted on ``reference`` (prepared input)."""
    if model is not None:
        return jobs.inference_job(batch, model=model, elasticity=elasticity)
    prepared = clean.prepare_inference_input(batch)
    scored = features.demand_score(prepared, fit_on=reference)
    best = select.best_price_elastic(jobs.prediction_frame(scored), elasticity=elasticity)
    return report.build_report(best)


def start_inference_stream(spark: SparkSession, source_dir: str, schema: T.StructType, reference: DataFrame | None,
                           sink_dir: str, checkpoint_dir: str, available_now: bool = True, max_files: int = 64,
                           model=None):
    """Start the streaming job: parquet listing files in ``source_dir`` -> report rows in ``sink_dir``.
    Pass either ``reference`` (fit of the demand target) or a fitted ``model``."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source_dir))
    # the statistics are fitted once, before the first batch: batches read one row, not the reference
    ref = features.demand_extremes(clean.prepare_inference_input(reference)) if reference is not None else None

    def write(batch: DataFrame, batch_id: int) -> None:
        (score_batch(batch, ref, model=model).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
