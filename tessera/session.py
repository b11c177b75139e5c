"""Session helpers: engine defaults and the shared folder for lineage cuts.

The engine never picks a machine-local folder on a cluster: durable
intermediate data (checkpoints, staged tables, landed bronze files) lives
under the folder the cluster names in ``spark.checkpoint.dir``. Only when the
session has none (tests, a laptop) do we create one.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Session options the engine relies on for correct results (UTC wall clock,
# zone-less timestamps) and for scale (AQE re-planning, skew splitting).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Size estimates from Parquet bytes undercount decompressed text (captions,
    # transcripts compress ~4x); scale them so the static planner does not
    # broadcast a text-heavy side. AQE still re-plans from real shuffle sizes.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.speculation", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime (SQL) options of ENGINE_CONF to an existing session."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create one only when unset."""
    d = None
    try:
        d = spark.conf.get("spark.checkpoint.dir")
    except Exception:
        d = None
    sc = None
    try:
        sc = spark.sparkContext
        d = d or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    except Exception:  # no SparkContext (remote session): conf only
        sc = None
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")  # one machine: tests, a laptop
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    try:
        spark.conf.set("spark.checkpoint.dir", d)
    except Exception:
        pass
    return d


def app_key(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", str(id(spark)))


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tessera", *parts, uuid.uuid4().hex)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder on a file system that driver and executors
    mount; None where ``path`` lies in another kind of store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def read_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The DataFrame that ``read`` opens; None only where its path does not
    exist. Any other failure is raised: it must not pass for an empty table."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared folder); survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside drop their shuffle files as they end; else these stay
    until the driver's garbage collector finds them. For one write each: what
    was written is read again, never the plan behind it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like ``cut_lineage``, in a
    fraction of the bytes, for rows whose partitions do not matter."""
    path = shared_path(df.sparkSession, "staged", *parts)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
