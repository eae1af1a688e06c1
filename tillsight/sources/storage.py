"""Written tables: versions that are switched at once, the shared folder for steps, views, upserts.

A table is a folder of versions. A version is written to a folder of its own and takes effect with one
marker file, created last: readers see the old table or the new one, never parts of both, and a write that
fails changes nothing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_VERSION = re.compile(r"v(\d{8})-[0-9a-f]{8}")
_MARKER = "_IN_EFFECT"
# folders of local sessions; they are removed when the process ends
_local_folder: dict[str, tempfile.TemporaryDirectory] = {}
# how often the tables of an application were released
releases: Counter[str] = Counter()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    app = context.applicationId
    if folder:
        return f"{folder.rstrip('/')}/tillsight-{app}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_folder:
        _local_folder[app] = tempfile.TemporaryDirectory(
            prefix="tillsight-", ignore_cleanup_errors=True
        )
    return _local_folder[app].name


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of the versions in effect, oldest first, and of those that never took effect."""
    files, at = _files(spark, path)
    if not files.exists(at):
        return [], []
    whole, broken = [], []
    for entry in files.listStatus(at):
        name = entry.getPath().getName()
        if entry.isDirectory() and _VERSION.fullmatch(name):
            done = files.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), _MARKER))
            (whole if done else broken).append(name)
    return sorted(whole), sorted(broken)


def in_effect(spark: SparkSession, path: str) -> str:
    """Folder of the files of a written table; a path that holds no versions is such a folder itself."""
    whole, _ = _versions(spark, path)
    return f"{path.rstrip('/')}/{whole[-1]}" if whole else path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The version of a written table that is in effect."""
    whole, _ = _versions(spark, path)
    if not whole:
        raise FileNotFoundError(f"no table at {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path.rstrip('/')}/{whole[-1]}")


def write_table(
    df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """Rebuild a Parquet table, and return it read back with its declared types.

    ``check`` is given the new version before it takes effect, and keeps it from that by raising. ``df``
    may read the table itself. The version before stays, for those who read it, until the next
    write; older ones, and what failed writes left, are deleted. One writer at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    whole, broken = _versions(spark, path)
    number = 1 + max((int(_VERSION.fullmatch(name)[1]) for name in whole + broken), default=0)
    version = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{version}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{version}")
    if check:
        check(written)
    files, marker = _files(spark, f"{path}/{version}/{_MARKER}")
    files.create(marker, False).close()  # from here on it is the table
    for name in whole[:-1] + broken:
        files.delete(_files(spark, f"{path}/{name}")[1], True)
    return written


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut the lineage through a table in the shared folder.

    Unlike an executor-side cache it survives the loss of executors, and a later step that
    reads two columns of it reads only those two.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables this application wrote to its shared folder. Frames that read them, and
    anything built on those, can no longer be used."""
    files, folder = _files(spark, shared_folder(spark))
    files.delete(folder, True)
    releases[spark.sparkContext.applicationId] += 1


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def preview_rows(df: DataFrame, n: int = 20, order=None) -> DataFrame:
    """The first ``n`` rows by all columns (or by ``order``), so that the answer is repeatable."""
    return df.orderBy(*(order or df.columns)).limit(n)


def upsert_table(new: DataFrame, path: str, key: str) -> DataFrame:
    """Upserts the rows of ``new`` into the table at ``path``, which then holds the outcome."""
    return write_table(upsert(read_table(new.sparkSession, path, new.schema), new, key), path)


def upsert(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace the rows of ``current`` with the same key; NULL keys replace nothing."""
    return current.join(new, key, "left_anti").unionByName(new)
