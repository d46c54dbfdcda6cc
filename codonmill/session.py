"""Session set-up for scripts, and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on stated explicitly.

    Adaptive execution picks broadcast sides from measured sizes, splits skewed
    join partitions and merges small ones; no job hard-codes any of these.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BYTES_PER_PARTITION = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, folder: str) -> int:
    """Give shuffles enough partitions for the files under `folder`, and return the number.

    Adaptive execution merges partitions that turn out small but adds none, so the
    first number has to suit the data. Only file lengths are looked at.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    total = files.agg(F.sum("length")).first()[0] or 0
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(total / BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


def shared_folder(spark: SparkSession) -> str:
    """A new path under the folder named by `spark.checkpoint.dir`.

    Only where that setting is absent and all runs on one machine is a temporary folder
    used; on a cluster the executors would not share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _laptop_folder()
    return f"{base.rstrip('/')}/codonmill-{uuid.uuid4().hex}"


@cache
def _laptop_folder() -> str:
    return tempfile.mkdtemp(prefix="codonmill-")
