"""Tables in the folder that driver and executors share, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow side that may be broadcast: at 8 to 24 bytes a row this is at most some 48 MB.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and everything runs on this machine (local tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="rollcall-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def materialise(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df written once as Parquet to the shared folder and read back: lineage ends there, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rollcall/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Removes this application's tables from the shared folder; frames made from them can't be read after that."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/rollcall/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it was counted at rows or fewer; else unmarked, for a shuffled join. df should be materialised."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
