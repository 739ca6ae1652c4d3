"""Where intermediate tables live.

Iterative operators cut their lineage by writing a parquet table to the shared
folder named by ``spark.checkpoint.dir`` and reading it back: the table
survives the loss of any executor, is written once, and gives the next stage
column pruning and exact size statistics.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


#: How joins of skeleton tables are planned.  Landed node tables hold up to some hundred times their file length: sorted
#: ids and few distinct values pack that well.  Relations of short rows take up to eight times their data in the driver.
_SIZES = {"spark.sql.sources.fileCompressionFactor": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m", "spark.sql.autoBroadcastJoinThreshold": "4m"}


def size_by_rows(spark: SparkSession) -> None:
    """Let joins be planned by what tables hold, not by their packed files.

    A node table of millions of rows can be a file under the broadcast limit; its
    join would send all of it through the driver.  With these settings only tiny
    files are broadcast from the plan, other sides when their measured size is small.
    """
    for name, value in _SIZES.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)


def size_by_files(spark: SparkSession) -> None:
    """Undo ``size_by_rows`` for queries over texts, which pack far less."""
    for name, value in _SIZES.items():
        if spark.conf.get(name, None) == value:
            spark.conf.unset(name)


def workspace(spark: SparkSession) -> str:
    """Shared scratch folder; a local one only when the master is local."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="arborspark-")
    return _LOCAL_FOLDERS[app]


def land(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the workspace and return the table read back."""
    spark = df.sparkSession
    path = f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete landed tables that nothing will read again, a recomputed task included."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
