"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants. AQE re-plans joins and
# coalesces/splits shuffle partitions at run time, which is what keeps the
# store-keyed and date-keyed shuffles healthy when one store is hot.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app_name: str = "shelfcast", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, ``master`` stays None and the submitter's settings win; the
    defaults below only fill in what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, wiring it into the SparkContext.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session (tests, laptops) may fall back to a fresh scratch folder; on a
    cluster a machine-local folder would be lost with its executor, so an
    unset value is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        path = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SHIPPED: set[str] = set()  # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfcast`` importable in the Python workers whatever the driver's working
    directory: zip the package once per application and add it with ``addPyFile``, as
    ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="shelfcast-pyfiles-"), "shelfcast.zip")
    with zipfile.ZipFile(out, "w") as zf:
        for root, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Later steps read the result once computed instead of planning it again, lost executors do not
    lose it, and joins see its real size."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
