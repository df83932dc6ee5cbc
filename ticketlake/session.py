"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings that matter for results or for plans at scale.  Anything a cluster
# already tunes (shuffle partitions, executor memory) is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "ticketlake") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def together(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent Spark jobs side by side, so that one's last tasks do not idle the cluster.

    All are waited for; the first failure is raised afterwards.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach.  Only a
    local session without that setting may use a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ticketlake-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
