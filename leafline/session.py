"""Session helpers: a local session for tests and a shared checkpoint folder.

On a cluster the session comes from the platform; ``checkpoint_dir`` only
reads ``spark.checkpoint.dir`` from it.  A folder is set here only when the
setting is absent (local tests), never on a cluster that names one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what is measured: no plan-time (estimated) broadcast;
    # AQE may still broadcast a side whose materialised size it has seen
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", app: str = "leafline") -> SparkSession:
    """A local session configured like the test suite expects."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Set one only where a local session names none (a test run); on a cluster
    a machine's own temporary folder would not be shared, so that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not d:
        if not (sc.master or "").startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="leafline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def materialise(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Whatever reads the result later sees the same rows, and lineage ends here."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/leafline-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
