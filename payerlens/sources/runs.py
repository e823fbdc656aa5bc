"""Runs of the claims pipeline: the tables of a run become visible together or not at all.

A run writes all its tables below a folder of its own, ``<base>/runs/<run id>``. Its last step
appends one row to the commit log, ``<base>/commits``: the run's manifest. That is one file, which
appears whole or not at all, so readers that resolve a base through the log see the
tables of the run before or of this one, never a mixture, wherever the writer stopped.

Expiry: a committed run is deleted when at least ``keep`` newer ones are committed and the
newest of them is ``grace`` old, so that readers of the older run can end. A run that was never
committed is deleted when a run that began after it has been committed for that long.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RUNS, _COMMITS = "runs", "commits"
_MANIFEST = (
    "run_id string, sequence bigint, committed_at string, tables array<string>, "
    "raw_rows bigint, clean_rows bigint, rejected map<string,bigint>"
)


class Run(NamedTuple):
    run_id: str
    folder: str
    sequence: int
    committed_at: datetime
    tables: list[str]
    raw_rows: int
    clean_rows: int
    rejected: dict[str, int]


def new_run(base: str) -> tuple[str, str]:
    """Id and folder of a run that begins now. Ids sort by their time."""
    run_id = f"{datetime.now(UTC):%Y%m%dt%H%M%S%f}_{uuid4().hex[:8]}"
    return run_id, _folder(base, run_id)


def _folder(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{_RUNS}/{run_id}"


def commit_log(spark: SparkSession, base: str) -> DataFrame | None:
    """All manifests of a base; None if nothing was ever committed there."""
    try:
        return spark.read.schema(_MANIFEST).json(f"{base.rstrip('/')}/{_COMMITS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed_runs(spark: SparkSession, base: str) -> list[Run]:
    """Newest first. Two runs that committed at once have one sequence: the later id counts as newer."""
    log = commit_log(spark, base)
    if log is None:
        return []
    rows = log.where(F.col("run_id").isNotNull()).collect()  # one row a run
    runs = [
        Run(r["run_id"], _folder(base, r["run_id"]), r["sequence"], datetime.fromisoformat(r["committed_at"]),
            list(r["tables"]), r["raw_rows"], r["clean_rows"], dict(r["rejected"] or {}))
        for r in rows
    ]
    return sorted(runs, key=lambda r: (r.sequence, r.run_id), reverse=True)


def current_run(spark: SparkSession, base: str) -> Run | None:
    runs = committed_runs(spark, base)
    return runs[0] if runs else None


def run_folder(spark: SparkSession, base: str) -> str:
    """The folder of the current run's tables.

    A base without commits holds its tables itself, as a run's own folder does.
    """
    run = current_run(spark, base)
    return run.folder if run else base


def table_folder(spark: SparkSession, path: str) -> str:
    """Where the files of ``<base>/<table>`` are: in the current run, or at the path itself."""
    base, _, name = path.rstrip("/").rpartition("/")
    run = current_run(spark, base) if base else None
    return f"{run.folder}/{name}" if run and name in run.tables else path


def commit_run(
    spark: SparkSession,
    base: str,
    run_id: str,
    tables: list[str],
    raw_rows: int,
    clean_rows: int,
    rejected: dict[str, int],
) -> None:
    """Makes a run the current one. All its tables have to be written."""
    sequence = max((r.sequence for r in committed_runs(spark, base)), default=0) + 1
    row = (run_id, sequence, datetime.now(UTC).isoformat(), tables, raw_rows, clean_rows, rejected)
    manifest = spark.createDataFrame([row], _MANIFEST)
    manifest.coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/{_COMMITS}")


def expired_runs(
    spark: SparkSession,
    base: str,
    keep: int = 2,
    grace: timedelta = timedelta(days=1),
    now: datetime | None = None,
) -> list[str]:
    """Ids of the runs that the rule above lets go, committed or not."""
    if keep < 1:
        raise ValueError("the current run is always kept")
    runs = committed_runs(spark, base)
    limit = (now or datetime.now(UTC)) - grace
    settled = [r for r in runs if r.committed_at <= limit]
    # The newest settled run's readers may still be at work on it and on what followed.
    gone = [r.run_id for i, r in enumerate(runs) if i >= keep and any(s.sequence > r.sequence for s in settled)]
    known = {r.run_id for r in runs}
    newest = max((r.run_id for r in settled), default="")
    there = _run_ids(spark, base)
    return sorted({i for i in there if i in gone or (i not in known and i < newest)})


def expire_runs(spark: SparkSession, base: str, **rule) -> list[str]:
    """Deletes the folders of expired runs. Their manifests stay in the log."""
    gone = expired_runs(spark, base, **rule)
    for run_id in gone:
        path, files = _file_system(spark, _folder(base, run_id))
        files.delete(path, True)
    return gone


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _run_ids(spark: SparkSession, base: str) -> list[str]:
    path, files = _file_system(spark, f"{base.rstrip('/')}/{_RUNS}")
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
