"""Session helpers: local test sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "geoobs", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_dir() -> tempfile.TemporaryDirectory:
    """Scratch folder of a local process without a shared one; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="geoobs-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session that names no folder gets a temporary one; a cluster session must name
    storage that every executor reaches.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to storage shared by all executors")
        base = _own_dir().name
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
