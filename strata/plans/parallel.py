"""Independent steps of a run, side by side."""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")

# Jobs that the driver submits at once; Spark shares the executors among them.
WORKERS = 4


def side_by_side(steps: Mapping[str, Callable[[], T]]) -> dict[str, T | Exception]:
    """What each step returns, or the exception that ended it, in the given order."""
    with ThreadPoolExecutor(WORKERS) as pool:
        started = {name: pool.submit(step) for name, step in steps.items()}
        return {name: s.exception() or s.result() for name, s in started.items()}
