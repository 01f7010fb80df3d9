"""Submit independent Spark jobs from driver threads.

The three dimensions do not depend on each other until the fact lookup, so
their jobs (gates, SCD2, snapshot writes) can run at the same time; Spark's
scheduler interleaves their tasks on the cluster. Results come back in input
order; the first failure is raised.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")


def run_parallel(tasks: dict[str, Callable[[], T]], max_workers: int | None = None) -> dict[str, T]:
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers or len(tasks)) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}
