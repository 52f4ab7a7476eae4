"""Where jobs put intermediate tables, checkpoints and outputs of their own."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session may go without: it gets a temporary folder. On a cluster a folder of
    one machine would be lost with it, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="txguard-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def new_dir(spark: SparkSession, purpose: str) -> str:
    return f"{shared_root(spark)}/txguard/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes the frame and reads it back: cuts the lineage and makes its size known to the planner."""
    spark = df.sparkSession
    path = new_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)
