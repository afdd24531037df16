"""Incremental load: new JSON Lines files become index batches, one per micro-batch.

Micro-batch numbers start anew with each checkpoint, so a stream writes under a name that lies in its checkpoint: a second
stream, or one whose checkpoint was lost, has another name and adds batches instead of overwriting some.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from voxgauge.operators.upsert import BATCH, write_batch
from voxgauge.plans.enrich import index_rows
from voxgauge.sources.rejects import accepted, reject_counts
from voxgauge.sources.reviews import stage_json


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name in the checkpoint; the first start writes one."""
    path = f"{checkpoint}/_writer"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    name = f"stream-{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
    return name


def start_ingest(
    spark: SparkSession,
    source: str,
    index_root: str,
    checkpoint: str,
    enrich: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = None,
    rejects_root: str | None = None,
) -> StreamingQuery:
    """Loads all files not seen yet and stops. Ids are deterministic and a batch overwrites only its own folder,
    so a replay after a failure changes nothing. With ``rejects_root`` each batch also leaves its reject counts.
    """
    writer = stream_name(spark, checkpoint)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(lines: DataFrame, number: int) -> None:
        staged = stage_json(lines)
        write_batch(index_rows(enrich(accepted(staged))), index_root, number, writer)
        if rejects_root:
            reject_counts(staged).write.mode("overwrite").json(f"{rejects_root}/writer={writer}/{BATCH}={number}")

    return (
        reader.text(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
