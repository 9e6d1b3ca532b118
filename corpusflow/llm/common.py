"""Shared helpers: shared-folder tables, table paths, null-safe word patterns."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word, for every operator whose contract speaks of words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a session in one process (master local, as in tests) gets a temporary folder, which driver
    and tasks share there; on any other master that is an error, as a machine-local folder would lose rows.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="corpusflow-"))
    return _own[0]


_scopes: list[list[str]] = []


@contextmanager
def collected():
    """The paths that save() writes inside, for drop_saved once their readers are done."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        _scopes.pop()


#: Under this setting Spark removes the shuffle files of an execution once it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def place(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    return f"{shared_dir(spark)}/corpusflow/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, tidy: bool = False, into: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage so that a
    lost executor costs one task, and fixes rows whose order or grouping a retry could change.

    tidy: its shuffle files go once it is written, not when the driver next collects its garbage. into: the path of a table
    that it is added to, and that is read back."""
    spark = df.sparkSession
    path = into or place(spark, name)
    for scope in _scopes:
        scope.append(path)
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, str(tidy or before == "true").lower())
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove these tables, or all that save() has written to the shared folder, once their readers are done."""
    jvm = spark.sparkContext._jvm
    for p in [f"{shared_dir(spark)}/corpusflow"] if paths is None else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def arrow_schema(ddl: str):
    """The Arrow schema of a DDL string; only the driver can parse one."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def packed(df: DataFrame, name: str = "row", without: tuple[str, ...] = ()) -> Column:
    """The columns of df as one struct, beside which helper columns clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without]).alias(name)
