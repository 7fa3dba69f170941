"""SparkSession defaults and the shared scratch / checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every pipeline relies on.  ANSI stays on (Spark 4
# default): dirty conversions go through try_cast / get, never a bare cast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, cores: int | None = None,
                shuffle_partitions: int | None = None,
                app_name: str = "stellate", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster call it without ``master``; the launcher provides it.
    """
    b = SparkSession.builder.appName(app_name)
    if master is None and cores is not None:
        master = f"local[{cores}]"
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", os.environ.get("STELLATE_DRIVER_MEMORY", "16g"))
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Only a local-mode session without one (tests, the
    benchmark) gets a private temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:                      # Spark Connect: no driver-side context
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stellate-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the plan) and, unlike an RDD checkpoint of an unpersisted frame, computes
    the plan only once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dealt(df, rows: int):
    """``df`` in partitions of about ``rows`` rows; as it is if it has no more.

    A small Parquet file is one partition however many rows it holds.
    """
    n = -(-df.count() // rows)
    return df.repartition(n) if n > 1 else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``stellate`` importable in the Python workers (once per application).

    The package is zipped on the driver and added with ``addPyFile``; Spark
    distributes it to every executor, so the pandas functions that run in
    tasks can import it wherever the driver was started from.
    """
    import zipfile
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:                      # Spark Connect
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="stellate-pyfiles-"), "stellate.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join("stellate", os.path.relpath(full, pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> str:
    """Checkpoint folder + package shipping: call before running pipelines."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)
