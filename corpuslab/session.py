"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "corpuslab") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own.

    Its inputs are single files of one row group, so the text tables are dealt over the
    cores (``spark.corpuslab.inputPartitions``); a session without that setting reads
    tables as they lie.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.corpuslab.inputPartitions", "" if cores == "*" else cores)
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that folder, so every executor sees it.  Where it is
    unset, a local master gets a temporary folder once for the session; on a
    cluster that folder would not be shared, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is unset on {master}; name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpuslab-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: cuts the lineage
    and survives the loss of executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The written intermediates of one run, removed as soon as nothing reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_dir(spark, name)
        self.saved: list[tuple[DataFrame, str]] = []

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}-{len(self.saved)}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.saved.append((out, path))
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete what ``save`` wrote for these frames."""
        for df, path in self.saved:
            if any(df is f for f in frames):
                self.remove(path)

    def close(self) -> None:
        """Delete all that the run wrote."""
        self.remove(self.root)

    def remove(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
