"""The complete run: extract, transform, load, verify, log."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from bazaarcube.operators.facts import quarantine
from bazaarcube.operators.quality import require_unique
from bazaarcube.plans.lattice import build_cubes
from bazaarcube.plans.star import build_star
from bazaarcube.schemas import FACT_KEYS, UNIQUE_BEFORE_LOAD
from bazaarcube.sinks.runlog import append_run, now
from bazaarcube.sinks.warehouse import VERSIONS, Star, publish_version
from bazaarcube.sources.operational import SourceConfig, Tables, load_sources, table_counts

@dataclass(frozen=True)
class RunResult:
    exit_code: int
    seconds: float
    run_id: str
    extracted: dict[str, int] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    star: Star | None = None
    error: str | None = None


def write_quarantine(star: Star, path: str) -> None:
    """Store the fact rows that some dimension does not know, beside the facts of ``path``."""
    for fact, keys in FACT_KEYS.items():
        quarantine(star[fact], list(keys)).write.mode("overwrite").parquet(f"{path}/quarantine/{fact}")


def run_etl(
    spark: SparkSession,
    source: SourceConfig | Tables,
    warehouse: str,
    cube_path: str | None = None,
    job: str = "etl",
) -> RunResult:
    """Refresh the warehouse (and, given ``cube_path``, all cubes) from the source.

    A refresh builds a new version of the star, with its quarantine, beside the old one.
    Readers follow a pointer that moves when all of that and all cubes are stored, so a
    failed refresh leaves the old star as it was, and running twice changes nothing. A
    failure is logged and reported with exit code 1 rather than raised.
    """
    start = now()
    log = f"{warehouse}/pipeline_runs"
    extracted: dict[str, int] = {}
    loaded: dict[str, int] = {}
    try:
        raw = load_sources(spark, source) if isinstance(source, SourceConfig) else source
        extracted = {row["bang"]: row["so_dong"] for row in table_counts(raw).collect()}
        require_unique(raw, UNIQUE_BEFORE_LOAD)
        version = f"{start:%Y%m%dT%H%M%S%f}"
        star = build_star(spark, raw, f"{warehouse}/{VERSIONS}/{version}")
        loaded = dict(star.rows)
        write_quarantine(star, f"{warehouse}/{VERSIONS}/{version}")
        if cube_path is not None:
            for subject in ("order", "inventory"):
                build_cubes(star, cube_path, subject)
        publish_version(spark, warehouse, version)
    except Exception as failure:
        text = f"{type(failure).__name__}: {failure}"
        run_id = append_run(
            spark, log, job, start, "FAILED", sum(extracted.values()), sum(loaded.values()), text
        )
        return RunResult(1, (now() - start).total_seconds(), run_id, extracted, loaded, error=text)
    run_id = append_run(spark, log, job, start, "SUCCESS", sum(extracted.values()), sum(loaded.values()))
    return RunResult(0, (now() - start).total_seconds(), run_id, extracted, loaded, star)
