"""Stage tables: intermediates that several jobs read, kept as Parquet.

A written table cuts the lineage, outlives lost executors and gives Catalyst exact
sizes and column pruning, none of which a cache does.

Every application has a folder of its own for them, which is deleted when its driver ends. The
folder of a driver that was killed is deleted by a later one, once nothing was added to it
for ``KEEP_HOURS``.
"""

import tempfile
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target

# Session settings: the folder of the running job's stages, and after how many hours without a
# new stage the folder of another application counts as left behind (0: never).
_JOB = "tarmac.stage.job"
KEEP_HOURS, _KEEP = 168, "tarmac.stage.keep.hours"
_PREFIX = "tarmac-stages-"
_opened = set()
# Bytes of files behind one partition of a shuffle of their whole rows, which takes some
# times as many bytes as compressed columns do.
PARTITION_BYTES = 4 << 20


def stage_root(spark):
    """The shared folder for stage tables, ``spark.checkpoint.dir``.

    A session on one machine that names no folder gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
    return context.getCheckpointDir().rstrip("/")


def _files(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def own_folder(spark):
    """This application's folder below the stage root; it goes when the driver ends."""
    root = stage_root(spark)
    folder = f"{root}/{_PREFIX}{spark.sparkContext.applicationId}"
    if folder not in _opened:
        files, path = _files(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _opened.add(folder)
        sweep(spark)
    return folder


def sweep(spark):
    """Delete the folders that other applications left behind, and return their names."""
    hours = float(spark.conf.get(_KEEP, str(KEEP_HOURS)))
    files, root = _files(spark, stage_root(spark))
    own, oldest = spark.sparkContext.applicationId, (time.time() - hours * 3600) * 1000
    gone = []
    for entry in files.listStatus(root) if hours else ():
        name = entry.getPath().getName()
        left = name.startswith(_PREFIX) and entry.getModificationTime() < oldest
        if left and name != f"{_PREFIX}{own}":
            files.delete(entry.getPath(), True)
            gone.append(name)
    return gone


def new_stage_path(spark, name):
    """A fresh folder name below the running job's folder, or else the application's."""
    root = spark.conf.get(_JOB, "") or own_folder(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job(spark):
    """Delete the stages made inside when the job ends, be it by an error.

    What is to outlive the job must be written inside it. A job inside another one belongs to
    the outer; jobs at the same time need sessions of their own.
    """
    if spark.conf.get(_JOB, ""):
        yield
        return
    folder = f"{own_folder(spark)}/job-{uuid.uuid4().hex}"
    spark.conf.set(_JOB, folder)
    try:
        yield
    finally:
        spark.conf.unset(_JOB)
        delete(spark, folder)


def delete(spark, path):
    """Delete a stage that nothing reads any more."""
    files, path = _files(spark, path)
    files.delete(path, True)


def keep(table, name, compression="snappy", path=None):
    """Write the table as a stage and return the written copy.

    At a ``path`` of its own it replaces what is there, and outlives the job.
    """
    spark = table.sparkSession
    path = path or new_stage_path(spark, name)
    table.write.mode("overwrite").option("compression", compression).parquet(path)
    return spark.read.schema(table.schema).parquet(path)


@contextmanager
def shuffle_partitions_for(table):
    """More shuffle partitions for the jobs inside if the files of the table are large.

    A fixed number of partitions would let the part of a task grow with the table. Only the
    sizes of the files are looked up; a table without files leaves the number as it is.
    """
    spark = table.sparkSession
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    size = 0
    for file in table.inputFiles():
        files, path = _files(spark, spark._jvm.java.net.URI(file))
        size += files.getFileStatus(path).getLen()
    spark.conf.set(name, str(max(int(before), -(-size // PARTITION_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep_all(**tables):
    """Write independent tables at the same time and return the written copies.

    The jobs share the executors, so a short one runs beside the tail of a long one.
    """
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        write = inheritable_thread_target(spark)(lambda item: keep(item[1], item[0]))
        return tuple(pool.map(write, tables.items()))
