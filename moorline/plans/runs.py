"""The run log around a job."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from moorline.operators.control import RUN_EVENT, run_events
from moorline.sinks.write import write_df


@contextmanager
def logged_run(
    spark: SparkSession, path: str, job_id: str, run_id: str, attempt: int = 1, job_name: str | None = None
) -> Iterator[None]:
    """Append a ``Started`` row, then ``Completed``, or ``Failed`` with the error, which is raised again.

    The log is append-only: a retry is a new attempt, and no run replaces another.
    """

    def append(state: str, error: str | None = None) -> None:
        row = (job_id, run_id, attempt, job_name, spark.sparkContext.applicationId, state, error, None)
        event = spark.createDataFrame([row], RUN_EVENT).withColumn("event_time", F.current_timestamp())
        write_df(run_events(event), path)

    append("Started")
    try:
        yield
    except Exception as error:
        append("Failed", str(error))
        raise
    append("Completed")
