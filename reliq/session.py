"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Hours and days of a timestamp must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # A strict cast has to raise on a malformed value.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Hot join keys are split at run time, also when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The few outcomes of a row are written side by side, without sorting all rows by them.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings every operator relies on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(master: str | None = None, app_name: str = "reliq", **settings: str) -> SparkSession:
    """A configured session; ``settings`` use ``__`` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a query is removed when it ends, not when the driver collects garbage.

    For frames that are run once: a second run would shuffle anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="reliq-")
    context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/reliq/{purpose}-{uuid.uuid4().hex}"
