"""Session settings the operators rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Set on any session the library is used with; all are runtime settings.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes; split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_conf(spark: SparkSession) -> None:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)


def local_session(cores: str = "*", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """Session for tests and the local bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("costloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _base(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables.

    It lies below ``spark.checkpoint.dir``. A local session may leave that unset
    and uses its warehouse; on a cluster a folder that all machines share must be named.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/costloom-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder all executors can reach; ``clean_up`` removes it."""
    return f"{_base(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    The rows outlive a lost executor, are computed once whoever reads them, and
    the planner knows their size and may prune their columns.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def clean_up(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results that still read them must be done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_base(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
