"""Where temporary tables go: the shared folder of the cluster, never a machine's own."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``. Where that is unset, a session of one machine gets a folder of its
    temp folder and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/tessera-scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
