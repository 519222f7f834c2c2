"""Structured Streaming forms of scoring and record appends.

Both are stateless per record. One query reads the source; each micro-batch is
split into accepted and quarantined rows, each written to a new folder under the
batch's number, and then listed; readers take listed folders only, so they never
see half a batch. The checkpoint lies beside the output, so a later run on the
same output goes on where the last one stopped, and a batch that is run again
after a failure replaces its own entry: every record lands once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import validate as val
from ..plans.jobs import Bundle, score
from ..session import scratch_path
from ..spec import Rule

#: Folder level that holds one micro-batch.
BATCH = "batch_id"
#: Folder with a file per landed micro-batch that names where its rows are.
LANDED = "_landed"


def _enlist(spark: SparkSession, path: str, number: int, folder: str) -> None:
    """Names ``folder`` as the place of a batch's rows; it replaces what an earlier run of the batch wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LANDED}/{number}")
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(f"{folder}\n".encode()))
    out.close()


def _run(spark: SparkSession, source_path: str, schema: T.StructType, split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
         out_path: str, quarantine_path: str, checkpoint: str | None, available_now: bool) -> StreamingQuery:
    def land(batch: DataFrame, number: int) -> None:
        folder = f"{BATCH}={number}/{uuid.uuid4().hex}"
        batch = batch.persist()  # the source is read once for both outputs
        try:
            for rows, path in zip(split(batch), (out_path, quarantine_path)):
                rows.write.parquet(f"{path}/{folder}")
        finally:
            batch.unpersist()
        for path in (out_path, quarantine_path):
            _enlist(spark, path, number, folder)

    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    query = (spark.readStream.schema(schema).parquet(source_path).writeStream.foreachBatch(land)
             .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}_checkpoint").trigger(**trigger).start())
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return query


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches landed under ``path`` so far; raises if there are none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LANDED}")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"no batch landed under {path}")
    folders = [r.value for r in spark.read.text(f"{path}/{LANDED}").collect()]  # a line per batch
    return spark.read.parquet(*(f"{path}/{f}" for f in sorted(folders)))


def stream_score(spark: SparkSession, source_path: str, schema: T.StructType, bundle: Bundle, out_path: str | None = None,
                 quarantine_path: str | None = None, checkpoint: str | None = None,
                 available_now: bool = True) -> tuple[str, str, StreamingQuery]:
    """ST1: score every arriving record; accepted and quarantined rows go to two folders.

    Returns both paths and the query (ended, if ``available_now``). The checkpoint is
    ``<out_path>_checkpoint`` unless given.
    """
    out_path = out_path or scratch_path(spark, "scored")
    quarantine_path = quarantine_path or f"{out_path.rstrip('/')}_quarantine"
    query = _run(spark, source_path, schema, lambda rows: score(rows, bundle), out_path, quarantine_path, checkpoint, available_now)
    return out_path, quarantine_path, query


def stream_append(spark: SparkSession, source_path: str, schema: T.StructType, rules: Sequence[Rule], out_path: str | None = None,
                  quarantine_path: str | None = None, checkpoint: str | None = None,
                  available_now: bool = True) -> tuple[str, str, StreamingQuery]:
    """ST2: append arriving records for retraining; rows breaking a rule are
    quarantined with their error codes instead of being appended.

    Returns both paths and the query; a second call with the same ``out_path``
    lands the records that have arrived since.
    """
    out_path = out_path or scratch_path(spark, "appended")
    quarantine_path = quarantine_path or f"{out_path.rstrip('/')}_quarantine"
    query = _run(spark, source_path, schema, lambda rows: val.quarantine_split(rows, rules), out_path, quarantine_path, checkpoint, available_now)
    return out_path, quarantine_path, query
