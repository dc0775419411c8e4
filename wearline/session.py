"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "wearline", master: str | None = None, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python call site of every expression slows the building of wide plans.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint directory the cluster names."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="wearline-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/wearline-{context.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once and go on from the written table.

    Used where a result is read more than once or depends on physical placement: a lost
    executor then re-reads the same rows, and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """As `stage`, with the number of rows, counted while they are written."""
    observation = Observation()
    staged = stage(df.observe(observation, F.count(F.lit(1)).alias("n")), name)
    return staged, observation.get["n"]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def drop_stages(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when all results are written."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text at `path`, where nothing is yet; it is there whole or not at all."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fresh = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    store.rename(fresh, target)


def last_text(spark: SparkSession, folder: str, suffix: str) -> str | None:
    """The text of the last file by name that ends in `suffix`, None where there is none."""
    if not path_exists(spark, folder):
        return None
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in store.listStatus(root))
    names = [n for n in names if n.endswith(suffix)]
    if not names:
        return None
    file = store.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{names[-1]}"))
    text = bytes(file.readAllBytes()).decode()
    file.close()
    return text
