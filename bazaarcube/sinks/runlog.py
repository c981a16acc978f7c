"""The log of pipeline runs: one appended row per run."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from bazaarcube.schemas import RUN_LOG_SCHEMA


def now() -> datetime:
    return datetime.now(timezone.utc)


def append_run(
    spark: SparkSession,
    path: str,
    job: str,
    start: datetime,
    status: str,
    extracted: int = 0,
    loaded: int = 0,
    error: str | None = None,
) -> str:
    run_id = uuid.uuid4().hex
    row = (run_id, job, start, now(), status, extracted, loaded, error)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
