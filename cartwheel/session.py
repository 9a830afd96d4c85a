"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on. They can be set on a session that somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # times with statistics, so that filters on them skip row groups
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # streamed sessions of one user are merged in every task before they are shuffled
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


_marked: set[str] = set()


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    if not app_name:
        raise ValueError("app_name is required: name the job")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where that is unset, a single machine uses its warehouse; a cluster is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder of this application, which is deleted when the driver's JVM ends."""
    own = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    if own not in _marked:
        where = spark._jvm.org.apache.hadoop.fs.Path(own)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        _marked.add(own)
    return f"{own}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once and continue from the files.

    For results read by several branches of a plan: the branches then read only their own columns
    instead of computing everything again, and a lost executor re-reads files.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
