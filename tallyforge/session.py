"""Session helpers: a local session for tests and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="8", app="tallyforge"):
    """A local session for tests and the bench; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark):
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyforge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark, label):
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df, label="stage"):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of an intermediate result that several later jobs read; the
    written table survives lost executors, unlike a cache.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    # the schema is known: no job has to read it from the files
    return df.sparkSession.read.schema(df.schema).parquet(path)
