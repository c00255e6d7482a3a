"""Readers and writers of the pipeline's files."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON array or document, plain or gzipped, by an explicit schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """RFC 4180 quoting and CRLF line ends, with a header."""
    df.write.option("header", True).option("quote", '"').option("escape", '"').option("lineSep", "\r\n").csv(path)


def geojson_features(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One point feature for each row with coordinates, as JSON text."""
    shape = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    rest = F.struct(*(c for c in df.columns if c not in (lat, lon)))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), rest.alias("properties"))
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.to_json(feature).alias("feature"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, a temporary one, but only on a local master: on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="claimloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """df by these columns over as many partitions as shuffles have: short rows would be put together into one task by their bytes, however long an expression takes on each of them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def materialise(df: DataFrame) -> DataFrame:
    """df as a table written to the shared folder, which cuts its lineage: a lost executor can then cost no more than the stage that is running. The files go when the
    driver's process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/claimloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended before: the folder's owner clears it
        pass
