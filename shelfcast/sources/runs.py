"""Run log and model store as tables.

Runs are appended as rows to a Parquet table; the newest runs are an ordered limit over it, and
``compact`` folds its one-row files. A model is saved in a folder of its own, whose last file is its entry (name, time):
a save that dies leaves a folder without an entry, which no reader sees, and writers share no file. "Latest" is
the maximum timestamp over the entries, not the largest file name.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = ("run_id string, parent_id string, name string, params map<string,string>, "
              "metrics map<string,double>, start_ts timestamp")


RUN_COLUMNS = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", RUN_SCHEMA)]
ENTRY_SCHEMA = "name string, created_at timestamp"


class RunStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def log_run(self, name: str, params: dict, metrics: dict, parent_id: str | None = None,
                run_id: str | None = None, start_ts: float | None = None) -> str:
        """Append one run row (nested runs point at their parent)."""
        run_id = run_id or uuid.uuid4().hex
        ts = dt.datetime.fromtimestamp(start_ts or time.time(), tz=dt.timezone.utc).replace(tzinfo=None)
        row = (run_id, parent_id, name, {str(k): str(v) for k, v in params.items()},
               {str(k): float(v) for k, v in metrics.items()}, ts)
        self.spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(self.path)
        return run_id

    def runs(self) -> DataFrame:
        """All runs; a run that stands both in a compacted file and in its own (a compaction that died) counts once."""
        return self.spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", True).parquet(self.path) \
            .groupBy("run_id").agg(*[F.first(c).alias(c) for c in RUN_COLUMNS[1:]]).select(RUN_COLUMNS)

    def compact(self) -> int:
        """Fold the files present now into one; returns how many were folded.

        The new file is complete before an old one goes, and only files that it was made from go, so runs logged
        meanwhile stay and a compaction that dies at any point loses nothing."""
        read = self.spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", True).parquet(self.path)
        files = [r[0] for r in read.select("_metadata.file_path").distinct().collect()]  # one a run since the last compaction
        if len(files) < 2:
            return 0
        old = self.spark.read.schema(RUN_SCHEMA).parquet(*files).dropDuplicates(["run_id"])
        old.coalesce(1).write.parquet(f"{self.path}/compact-{uuid.uuid4().hex}")
        for f in files:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, False)
        return len(files)


def latest_runs(runs: DataFrame, n: int = 15) -> DataFrame:
    """Newest ``n`` runs with RMSPE and R^2 formatted for display."""
    rmspe = F.coalesce(F.col("metrics")["RMSPE"], F.col("metrics")["best_RMSPE"])
    r2 = F.coalesce(F.col("metrics")["R2"], F.col("metrics")["best_R2"])
    return (runs.orderBy(F.desc("start_ts")).limit(n)
            .select("run_id", "name", F.coalesce(F.col("params")["model_type"], F.col("name")).alias("model_type"),
                    "start_ts",
                    F.when(rmspe.isNull(), "-").otherwise(F.format_string("%.2f%%", rmspe)).alias("rmspe"),
                    F.when(r2.isNull(), "-").otherwise(F.format_string("%.4f", r2)).alias("r2")))


class ModelStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def save(self, model, name: str) -> str:
        """Save under a folder of its own; its entry, written last, makes it visible in one step."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        path = f"{self.base}/models/{now:%Y%m%dT%H%M%S%f}_{name.replace(' ', '_')}_{uuid.uuid4().hex[:8]}"
        if hasattr(model, "trees"):
            model.save(path)
        else:
            model.write().overwrite().save(path)
        self.spark.createDataFrame([(name, now)], ENTRY_SCHEMA).coalesce(1).write.parquet(f"{path}/entry")
        return path

    def entries(self) -> DataFrame | None:
        """All saved models: name, created_at, path (None before the first)."""
        try:
            found = self.spark.read.schema(ENTRY_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(f"{self.base}/models/*/entry")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return found.withColumn("path", F.regexp_replace("_metadata.file_path", "/entry/[^/]*$", ""))

    def load_latest(self, name: str | None = None) -> tuple:
        """The most recently saved model (optionally of one name) and its folder."""
        entries = self.entries()
        if entries is None:
            return None, None  # no model saved yet
        if name:
            entries = entries.where(F.col("name") == name)
        row = entries.orderBy(F.desc("created_at"), F.desc("path")).select("path").first()
        if row is None:
            return None, None
        return self._load(row[0]), row[0]

    def _load(self, path: str):
        """A Spark ML pipeline, or an ensemble (its tree table lies beside its feature stages)."""
        from shelfcast.plans.ensembles import EnsembleModel
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/trees/_SUCCESS")
        if mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark):
            return EnsembleModel.load(self.spark, path)
        return PipelineModel.load(path)
