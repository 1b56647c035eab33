"""Independent Spark jobs of one step, submitted at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(*jobs: Callable) -> list:
    """Run jobs that do not depend on each other, and return their results in order.

    Small tables then do not wait for the large one, and the cluster is kept busy.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inherit(job)) for job in jobs]
        return [job.result() for job in started]
