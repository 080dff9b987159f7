"""Submitting independent Spark jobs together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def side_by_side(jobs: Sequence[Callable[[], Result]], parallel: int = 1) -> list[Result]:
    """Call the jobs, up to ``parallel`` at a time, and return their results in order.

    Job group, tags and scheduler pool of the caller hold for the jobs as well, and so do its context variables.
    """
    session = SparkSession.getActiveSession()
    calls = [inheritable_thread_target(session)(job) if session else job for job in jobs]
    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        contexts = [copy_context() for _ in calls]
        return list(pool.map(lambda context, call: context.run(call), contexts, calls))
