"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, str] = {}  # application that has the package


def local_session(cores: int | str = 8, app: str = "tabwright") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a temporary folder; on a
    cluster that would lose data with the machine, so it is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabwright-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to all executors, once a session, for a driver that was started from another folder.

    Where the package's parent is the working folder or on PYTHONPATH the
    workers find it there, and nothing is sent. The archive lies in the
    session's own folder, which Spark removes when it stops.
    """
    folder = pathlib.Path(__file__).resolve().parent
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(folder.parent) in [os.path.realpath(p) for p in paths if p]:
        return
    sc = spark.sparkContext
    if _SHIPPED.get("to") == sc.applicationId:
        return
    target = pathlib.Path(SparkFiles.getRootDirectory()) / "shipped" / folder.name
    target.parent.mkdir(exist_ok=True)
    sc.addPyFile(shutil.make_archive(str(target), "zip", folder.parent, folder.name))
    _SHIPPED["to"] = sc.applicationId
