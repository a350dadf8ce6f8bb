"""Local sessions for tests and the benchmark, and the shared folder for written tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", app="reviewmill", memory="12g", **conf):
    """A local session. On a cluster the session comes from spark-submit instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark, name):
    """A new path in the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table_path(spark, name):
    """A new folder for a catalog table, in the warehouse beside the other tables of its database."""
    *database, table = name.replace("`", "").split(".")
    root = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}-{uuid.uuid4().hex}"


def drop_scratch(spark, path):
    """Delete a folder that came from ``scratch_path`` or ``table_path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
