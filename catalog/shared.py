"""Where queries that write files put them."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in the folder that the cluster shares.

    `spark.checkpoint.dir` names that folder. Where it is unset a local session
    uses one folder of this machine, which goes when the process ends; on a
    cluster executors would each write to their own, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="amity-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
