"""Sink: a full rebuild written as tables and published as a whole.

The hub tables read by several others (events with their owners; per-send
campaign metrics; metrics by member) are stored as soon as they are planned, and
whatever reads them is planned on the stored copy. So each hub is computed once,
and a lost executor costs a re-read of a stored hub, not a recomputation of the
upstream joins. The campaign and the automation side do not depend on each other
and are stored side by side; every other table is submitted as a job once the
tables it reads are stored, with at most ``max_parallel_jobs`` jobs at a time.

NOT NULL failures are counted while the tables are written (``Written.not_null``),
without a further scan. Everything goes into tables of the run's own, and one
manifest makes it the current build (see ``publish``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock, Semaphore

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import NOT_NULL_TESTS
from ..options import Options
from .build import HUBS, OUTPUTS, build
from .publish import KEEP, STALE_HOURS, Build, Run


class Written(dict):
    """Location of each table written, by name; the published ``build``;
    ``not_null``: (model, column) -> NULL values, of each declared test on them."""

    def __init__(self, build: Build, not_null: dict[tuple[str, str], int]):
        super().__init__(build.tables)
        self.build, self.not_null = build, not_null


def _together(pool: ThreadPoolExecutor, *parts: Callable) -> list:
    futures = [pool.submit(p) for p in parts]
    return [f.result() for f in futures]


def write_build(spark: SparkSession, raw: dict[str, DataFrame], target: str,
                options: Options = Options(), fmt: str = "parquet", staging: bool = True,
                database: str | None = None, partition_by_source: bool = False,
                max_parallel_jobs: int = 4, keep: int = KEEP, stale_hours: float = STALE_HOURS) -> Written:
    """Build, write and publish every output (and staged table); returns name -> location.

    ``read_build(spark, target)`` gives the tables of the newest build. With
    ``database`` the tables are saved in the catalog instead of under ``target``,
    and views ``<database>.<name>`` show the newest (databases are created if
    needed). ``partition_by_source`` writes one folder per connection, so readers
    filtering on ``source_relation`` skip the other accounts' files. The newest
    ``keep`` builds stay; runs that were killed are swept ``stale_hours`` later.
    """
    with Run(spark, target, database, fmt, keep, stale_hours) as run:
        names, not_null = _write(run, raw, options, staging, "source_relation" if partition_by_source else None,
                                 max(1, max_parallel_jobs))
        published = run.publish(names)
        run.tidy(published)
    return Written(published, not_null)


def _write(run: Run, raw: dict[str, DataFrame], options: Options, staging: bool, partition_column: str | None,
           jobs: int) -> tuple[list[str], dict[tuple[str, str], int]]:
    slots, lock = Semaphore(jobs), Lock()
    names: list[str] = []
    not_null: dict[tuple[str, str], int] = {}

    def save(name: str, df: DataFrame) -> None:
        if partition_column:
            # one task per account and file: AQE splits large accounts, merges small ones
            df = df.hint("rebalance", partition_column)
        tested = [c for m, c in NOT_NULL_TESTS if m == name]
        seen = Observation()
        if tested:
            # in the writing stage, so that a stage run again does not count twice
            df = df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in tested])
        with slots:
            run.save(name, df, partition_column)
        with lock:
            names.append(name)
            if tested:
                not_null.update({(name, c): n for c, n in seen.get.items()})

    def materialize(name: str, df: DataFrame) -> DataFrame:
        save(name, df)
        return run.read(name)

    with ThreadPoolExecutor(2) as sides, ThreadPoolExecutor(jobs) as pool:
        submitted: list[Future] = []

        def ready(name: str, df: DataFrame) -> None:
            if name not in HUBS and (name in OUTPUTS or staging and name.startswith("stg_")):
                submitted.append(pool.submit(save, name, df))

        together = (lambda *parts: _together(sides, *parts)) if jobs > 1 else None
        build(raw, options, materialize=materialize, ready=ready, together=together)
        for job in submitted:
            job.result()  # raises the first failure
    return names, not_null
