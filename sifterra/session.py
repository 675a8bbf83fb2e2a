"""Session, table loading and shared-folder helpers used by every operator."""

from __future__ import annotations

import atexit
import hashlib
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "sifterra", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and Arrow on. A cluster's own settings win where a session exists."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Where that is unset, a temporary one in local mode, and an error on a cluster, whose executors have no disk in common."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):  # local masters run all processes on one machine
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = "file://" + tempfile.mkdtemp(prefix="sifterra_")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a reliable copy: a lost executor costs nothing that was
    written, and several consumers read it without computing it again.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{label}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._sifterra_path = path
    return back


def release(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for this frame, once nothing reads it any more."""
    path = getattr(df, "_sifterra_path", None)
    if path:
        _delete(df.sparkSession, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any storage the session reaches. Errors are raised, not taken for absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_CLEANED: set[str] = set()


def _own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is deleted when the driver ends."""
    folder = f"{shared_folder(spark)}/sifterra_{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(clear_materialized, spark, folder)
    return folder


def clear_materialized(spark: SparkSession, folder: str | None = None) -> None:
    """Delete all that ``materialize`` wrote in this application. Frames that read it can't be used afterwards."""
    try:
        folder = folder or _own_folder(spark)
        _delete(spark, folder)
    except Exception:  # the session has ended already
        if folder and folder.startswith("file:"):
            shutil.rmtree(folder.removeprefix("file:").replace("//", "/", 1), ignore_errors=True)


def few_files(df: DataFrame, most: int = 256) -> DataFrame:
    """For fitting only: a Parquet table of more than ``most`` files as that many of them, chosen by the hash of their names.

    So a bounded sample reads a bounded part of a table of any size. Tables of fewer files, and frames that are
    more than columns of one table, come back unchanged.
    """
    nodes = set(re.findall(r"(?m)^[\s:+-]*(\w+)", df._jdf.queryExecution().analyzed().treeString()))
    if not nodes <= {"Relation", "LogicalRelation", "Project", "SubqueryAlias"}:
        return df
    files = df.inputFiles()
    if len(files) <= most or not all(f.endswith(".parquet") for f in files):
        return df
    chosen = sorted(files, key=lambda f: hashlib.md5(f.encode()).hexdigest())[:most]
    part = df.sparkSession.read.parquet(*chosen)
    return part.select(*df.columns) if set(df.dtypes) <= set(part.dtypes) else df


def bounded_sample(df: DataFrame, keys: list[str], bound: int, seed: int = 17) -> list:
    """At most ``bound`` rows, chosen by the hash of their keys, on the driver.

    For fitting classifiers only. One cheap count fixes the rate; the hash filter runs where
    the rows are, so what reaches the driver follows ``bound``, not the table.
    """
    total = df.count()
    if total == 0:
        return []
    if total <= bound:
        return df.collect()
    scale = 1 << 30
    rate = min(scale, int(scale * (bound + 10 * bound**0.5 + 10) / total) + 1)
    place = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    # The lowest hashes of those under the rate, whatever the partitions.
    near = df.where(F.pmod(place, F.lit(scale)) < rate).withColumn("_place", F.pmod(place, F.lit(scale)))
    return near.orderBy("_place", *keys).limit(bound).drop("_place").collect()


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, for deciding whether a side may be broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit_bytes: int = 64 << 20) -> DataFrame:
    """A broadcast hint only where the estimated size is within ``limit_bytes``; otherwise the plain frame."""
    return F.broadcast(df) if size_in_bytes(df) <= limit_bytes else df


def spread(df: DataFrame, most_bytes: int = 1 << 30) -> DataFrame:
    """A small table in fewer files than there are cores, spread over all of them, for costly work on its rows. Larger ones, and those in enough files, come back unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size_in_bytes(df) > most_bytes or not 0 < len(df.inputFiles()) < cores:
        return df
    return df.repartition(cores)


def env_int(name: str, default: int) -> int:
    return int(os.environ.get(name, default))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started.

    Where all processes share a file system, by the workers' search path; on a cluster by a zip of the
    sources sent to every executor. Once a context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_sifterra_shipped", False):
        return
    sc._sifterra_shipped = True
    package = os.path.dirname(os.path.abspath(__file__))
    if sc.master.startswith("local"):
        paths = [p for p in (sc.environment.get("PYTHONPATH"), os.path.dirname(package)) if p]
        sc.environment["PYTHONPATH"] = os.pathsep.join(paths)
        return
    place = tempfile.mkdtemp(prefix="sifterra_")
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    target = os.path.join(place, "sifterra.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
