"""Submitting independent Spark actions together."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def concurrently(*tasks: Callable[[], object]) -> list:
    """Run independent Spark actions as concurrent jobs from driver threads.

    Each action is its own job; running them together fills the cores a
    single job leaves idle in its tail stages. Results keep task order;
    the first failure is raised.
    """
    if len(tasks) == 1:
        return [tasks[0]()]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]
