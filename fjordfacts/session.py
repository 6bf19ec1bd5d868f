"""What a session must offer: the package on the executors, a shared folder to cut lineage in, sizes known before broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size, in bytes, of a side that an operator broadcasts by hint.
BROADCAST_LIMIT = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Puts this package on the executors' path, once per application, so Arrow functions can be loaded there."""
    sc = spark.sparkContext
    if getattr(sc, "_fjordfacts_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="fjordfacts-")) / "fjordfacts_pkg.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._fjordfacts_shipped = True
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where the session names none, a temporary one serves a local master (tests); a cluster must name one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="fjordfacts-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: lineage ends in the shared folder and outlives a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def cut_by(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Cuts lineage by a table in the shared folder, in `n` buckets by the columns: unlike a checkpoint it keeps the partitioning, so work by these columns needs no further shuffle."""
    name = f"fjordfacts_cut_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(df.sparkSession)}/{name}"
    df.repartition(n, *columns).write.format("parquet").option("path", path).bucketBy(n, *columns).sortBy(*columns).saveAsTable(name)
    return df.sparkSession.table(name)


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hints a broadcast only if Catalyst's own size estimate of the side stays under the limit; else the side is left to a shuffle join."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df


def measured_broadcast(df: DataFrame, bytes_a_row: Column | int, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hints a broadcast only if the side's measured size stays under the limit: for sides that were cut, of which the plan knows no size."""
    width = bytes_a_row if isinstance(bytes_a_row, Column) else F.lit(bytes_a_row)
    size = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if size <= limit else df


def tasks(df: DataFrame, mb: int = 8) -> int:
    """Partitions for a stage that computes much on few bytes, by the plan's size estimate: enough for all cores, and more as the data grows."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 50:  # no estimate: the plan says so by an enormous number
        return max(cores(df.sparkSession), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(cores(df.sparkSession), min(200_000, -(-size // (mb << 20))))


def spread(df: DataFrame) -> DataFrame:
    """At least one partition for each core: rows are shuffled only where the files give fewer."""
    n = cores(df.sparkSession)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def tokenizer_dir() -> str:
    return os.environ.get("FJORDFACTS_TOKENIZERS", "/opt/tokenizers")
