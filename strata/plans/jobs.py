"""Independent jobs side by side, in one Spark application.

Each job runs in an ``InheritableThread``, so it has the caller's local
properties, and submits its Spark jobs to a scheduler pool of its own: with
``spark.scheduler.mode=FAIR`` (the launcher's choice) a small job is not kept
waiting behind the tasks of a large one.  All jobs run to their end; what they
raised is reported together.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

T = TypeVar("T")


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Each job's result by name, in the order given.  One failure is raised
    as it is, several as an ``ExceptionGroup``."""
    results: dict[str, T] = {}
    errors: dict[str, Exception] = {}

    def run(name: str, job: Callable[[], T]) -> None:
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            results[name] = job()
        except Exception as e:  # kept for the caller
            e.add_note(f"in job {name}")
            errors[name] = e

    threads = [InheritableThread(target=run, args=(name, job)) for name, job in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if len(errors) > 1:
        raise ExceptionGroup(f"{len(errors)} of {len(jobs)} jobs failed: {', '.join(errors)}", list(errors.values()))
    for e in errors.values():
        raise e
    return {name: results[name] for name in jobs}
