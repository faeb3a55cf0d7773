"""Session helpers: a tuned builder for local runs and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` stays None and the submitter's settings win; the
    values here only fill what is unset.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    given = SparkConf()  # what spark-submit or spark-defaults set wins
    for k, v in conf.items():
        if k in (extra or {}) or not given.contains(k):
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, creating one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured on a local master (tests) do we make
    a fresh scratch folder under the system temp directory; elsewhere that
    would lose rows, so we raise.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for derived tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "cut"):
    """Cut the lineage of ``df`` by writing it as a table in the checkpoint folder.

    One job (the Parquet write); the result reads the files back with the
    known schema (no inference job).  The folder is the session's
    ``spark.checkpoint.dir`` -- shared storage on a cluster -- so the data
    survives the loss of any executor.
    """
    out, _ = write_table(df, name)
    return out


def write_table(df, name: str = "table"):
    """Materialise ``df`` as Parquet under the checkpoint folder and read it back.

    One job (the write); the returned DataFrame has no lineage beyond the
    files, which live in the shared checkpoint folder and so survive the
    loss of any executor.  Returns (DataFrame, path).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark, path: str) -> None:
    """Delete a folder written by ``write_table`` (Hadoop FileSystem API)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(p, True)


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``tessera`` importable in local-mode Python workers.

    The tile and search functions run in Python workers, which do not share
    the driver's ``sys.path``.  In local mode a zip of the package is added
    with ``addPyFile`` once per application.  On a cluster, submit the
    package the standard way (``spark-submit --py-files tessera.zip``);
    nothing is staged in a machine-local folder there.
    """
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tessera-pyfiles-")
    base = os.path.join(out_dir, "tessera")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="tessera")
    sc.addPyFile(archive)
    _SHIPPED.add(app)
