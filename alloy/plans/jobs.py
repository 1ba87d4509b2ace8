"""Submit independent Spark jobs from a few driver threads.

Spark's scheduler is thread-safe: jobs started from different threads run
at the same time and share the executors, so many small or unevenly sized
table jobs finish sooner than one after the other.  Only job submission
happens in these threads; all data work stays on the executors.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")

DEFAULT_PARALLEL = 4


def each(names: Iterable[str], work: Callable[[str], T],
         parallel: int = DEFAULT_PARALLEL) -> dict[str, T]:
    """``{name: work(name)}`` computed on up to ``parallel`` threads."""
    names = list(names)
    if parallel <= 1 or len(names) <= 1:
        return {n: work(n) for n in names}
    with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="alloy-jobs") as pool:
        return dict(zip(names, pool.map(work, names)))


@contextlib.contextmanager
def described(spark: SparkSession, text: str) -> Iterator[None]:
    """Label the jobs started in this thread (shown in event logs and the UI)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no job descriptions
        yield
        return
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(None)
