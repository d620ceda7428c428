"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """A session tuned for these jobs: AQE on (coalescing, skew-join split),
    UTC session time, UI off. What the deployment sets from outside
    (``--conf spark.sql.shuffle.partitions``, memory) is kept unless a value
    is passed here; size the shuffle count to about 128-256 MB per partition."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if "LEDGERLINE_DRIVER_MEMORY" in os.environ:
        conf["spark.driver.memory"] = os.environ["LEDGERLINE_DRIVER_MEMORY"]
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    The folder comes from ``spark.checkpoint.dir`` (a shared, cluster-visible
    path set by the deployment). Only a local-mode session without that
    setting (tests, the bench) gets a private temporary folder; a cluster
    session without it is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in the Python workers (needed by the one
    pandas function, the grouped Holt-Winters fit).

    A deployment normally passes the package with ``--py-files``; when it is
    not already listed there, the package is zipped once per SparkContext and
    added with ``addPyFile`` (Spark serves the file to every executor)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    listed = sc.getConf().get("spark.submit.pyFiles", "") or ""
    if "ledgerline" not in listed:
        import zipfile
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        out = os.path.join(tempfile.mkdtemp(prefix="ledgerline-pyfiles-"), "ledgerline.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
    _SHIPPED.add(app)
