"""Where jobs keep files that all machines must see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; without that setting only a local master gets one, a temporary one."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if place is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="kotonoha-")
    return f"{place}/kotonoha-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
