"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole documents travel through Arrow: small batches keep Python workers within memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Whole documents travel through Arrow: batches of the usual 10,000 rows would weigh on executors."""
    if int(spark.conf.get(BATCH_SETTING, "10000")) >= 10_000:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("nearkin")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own, because a machine-local path is unreadable from the
    other executors; it goes when the process ends.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="nearkin-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{work_dir(spark)}/nearkin/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` go to the writer.

    Cuts the lineage and survives the loss of executors. Being Parquet, later readers still
    get column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = f"{work_dir(spark)}/nearkin/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if own.split("://")[-1].lstrip("/") in folder:
            path.getFileSystem(configuration).delete(path, True)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give a small scan one partition per core before expensive per-row work.

    Files that already make at least as many tasks as there are cores, as large tables do,
    are left alone. Apply it to a file scan only: asking a plan with shuffles for its
    partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *keys)
