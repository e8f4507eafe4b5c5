"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def staging_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the cluster's shared checkpoint folder.

    Only a local session may do without the setting; a folder on one machine is of
    no use to the other machines of a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/siltgate/{purpose}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="siltgate-")


def written(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Write ``df``, in a folder for each value of ``by``, and read it back.

    That cuts the lineage and outlives lost executors.
    """
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
