"""What several families of column functions share."""

from __future__ import annotations

import os
import shutil
import site
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let executors import this package. Where workers find it by themselves (installed, in PYTHONPATH, or the working
    folder) nothing is done; else it goes with the session's Python files, once."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.realpath(os.path.join(os.path.dirname(__file__), "..", ".."))
    found = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd(), *site.getsitepackages(), site.getusersitepackages()]
    if root not in {os.path.realpath(p) for p in found if p}:
        package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="spark-package-")), package)
        context.addPyFile(shutil.make_archive(name, "zip", root, package))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session on one machine may lack that setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that nothing before it runs twice
    and a lost executor costs only a read."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c: Column | str) -> Column:
    """NULL for NULL and for the empty string."""
    return F.nullif(col(c), F.lit(""))


def casefold(c: Column | str) -> Column:
    """Upper, then lower case, so that ß equals ss. The empty text keeps the optimizer from taking lower(upper(x)) for lower(x)."""
    return F.lower(F.concat(F.upper(col(c)), F.lit("")))
