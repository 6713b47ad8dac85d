"""Session helpers: a local session for tests/bench and the checkpoint folder.

Library functions never create a session; they take DataFrames and use
``df.sparkSession``.  ``local_session`` exists for tests, the bench and the
driver entry only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "planekit") -> SparkSession:
    """A local[N] session with AQE on and the UI off (tests, bench)."""
    parts = shuffle_partitions or (cpus if isinstance(cpus, int) else 8)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and every executor share, private to this application.

    It lies under the checkpoint folder (``spark.checkpoint.dir``, or the one
    set on the context); where that is unset, under the SQL warehouse, the
    other folder that a Spark deployment shares.  The folder is removed when
    the application ends (Hadoop's ``deleteOnExit``).
    """
    sc = spark.sparkContext
    base = (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.sql.warehouse.dir"))
    path = f"{base.rstrip('/')}/planekit-work-{sc.applicationId}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(hadoop):
        fs.deleteOnExit(hadoop)
    return path


def cut_lineage(df, partition_by: str | None = None):
    """Materialise ``df`` as a Parquet table in the shared folder.

    One job writes it (``Dataset.checkpoint`` would compute the data twice:
    once for the eager count, once more to write the files), and the
    returned DataFrame reads it back: columnar, lineage cut at the files,
    so a lost executor costs a re-read, never a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
