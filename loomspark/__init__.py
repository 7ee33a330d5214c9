"""loomspark: eligibility matching, engagement marts, listings and notice pipelines as DataFrame functions."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def attach(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, from wherever the driver was started.

    On a cluster the package is shipped with --py-files or installed; a path that is not there does no harm.
    """
    root, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    if root not in (env.get("PYTHONPATH") or "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))
