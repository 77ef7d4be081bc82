"""Lineage cuts that survive lost executors, and size-checked joins."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

#: Rows and bytes up to which the small side of a join is broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a session on one machine (``local``) gets a temporary folder, once per
    application; on a cluster it is an error, since no machine's own folder would do.
    """
    conf = spark.sparkContext.getConf()
    if found := conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = spark.conf.get("spark.tracewright.scratch", None)
    if not made:
        made = "file://" + tempfile.mkdtemp(prefix="tracewright-")
        spark.conf.set("spark.tracewright.scratch", made)
    return made


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a reread and not a recomputation, and every later
    use of the result reads the same rows.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that no plan will read again."""
    for df in tables:
        root = shared_dir(df.sparkSession).split("://")[-1].lstrip("/")
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if root in folder:
                path.getFileSystem(conf).delete(path, True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    fixed = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
    sizes = [F.lit(8) if isinstance(f.dataType, fixed) else F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 16 for f in df.schema.fields]
    return reduce(lambda a, b: a + b, sizes, F.lit(16)).cast("long")


def small_or_not(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows (BROADCAST_ROWS by default) and BROADCAST_BYTES, else ``df`` itself.

    The caller's join is right either way; give narrow, stored tables, since they are read for it.
    """
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= (BROADCAST_ROWS if limit is None else limit) and size <= BROADCAST_BYTES else df


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
