"""Session and checkpoint helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: AQE (runtime broadcast decision with a real
# size check, partition coalescing, skew-join splitting), UTC session time and
# the legacy charsets needed by EUC-KR / x-windows-949 CSV feeds.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "clinloom", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, *, fallback_prefix: str = "clinloom-ckpt-") -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (registered with the
    SparkContext).  Only a session in local mode that names none (tests) gets a scratch
    folder; on a cluster that is an error."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix=fallback_prefix)
    sc.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut the lineage of ``df`` with a Parquet table written into the shared
    checkpoint folder and read back.  One pass over the plan (an RDD
    ``checkpoint`` runs it twice: once for the action, once for the files), the
    files survive executor loss, and later readers get column pruning and
    filter pushdown from the Parquet scan."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Remove the written table behind a result of ``materialize`` whose last reader is
    done (later results that were computed from it must be written themselves)."""
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.rsplit("/", 1)[-1].startswith("table-") and root.rsplit("/", 1)[-1] in path:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nobody holds any more.  It
    acts when the driver collects garbage, which a job of written stages seldom needs to."""
    spark.sparkContext._jvm.System.gc()
