"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="comarca-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below the session's ``spark.checkpoint.dir``.

    That folder is shared by all executors. Paths of one application lie in one folder named
    after it, to be removed when the application is done. A machine-local folder is used
    only when the setting is absent and Spark runs on this machine alone; it goes when Python
    exits.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        folder = _local_folder().name
    application = spark.sparkContext.applicationId
    return f"{folder.rstrip('/')}/comarca/{application}/{name}-{uuid4().hex}"
