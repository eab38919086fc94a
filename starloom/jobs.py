"""Independent Spark jobs side by side, so the tail of one does not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

MAX_TOGETHER = 8


def together(*jobs: Callable[[], Any]) -> list[Any]:
    """Run actions in threads that inherit the session's local properties; results in order, first error raised."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(min(len(jobs), MAX_TOGETHER)) as pool:
        return [future.result() for future in [pool.submit(copy_context().run, inherit(job)) for job in jobs]]
