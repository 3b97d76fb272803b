"""Tables written to the cluster's shared folder, used to cut lineage and to hand results on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}
_stored: dict[tuple, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only for a local master without it."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ledgerflow-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ledgerflow/{uuid.uuid4().hex}/{name}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: lineage ends here and a lost executor recomputes nothing above."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _files(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of the files under a folder, two levels deep."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def below(place, depth: int) -> list[tuple]:
        found = []
        for s in files.listStatus(place):
            if s.isDirectory() and depth:
                found += below(s.getPath(), depth - 1)
            else:
                found.append((str(s.getPath()), s.getLen(), s.getModificationTime()))
        return found

    return tuple(sorted(below(path, 1)))


def stored_once(spark: SparkSession, key: tuple, build) -> DataFrame:
    """``store`` a derived table once per application and state of the files it is derived from.

    ``key`` is (name, folder of the sources); a changed, added or removed file there gives a new key.
    """
    full_key = (spark.sparkContext.applicationId, *key, _files(spark, key[-1]))
    if full_key not in _stored:
        path = fresh_path(spark, "-".join(str(k).strip("/").replace("/", "_") for k in key))
        build().write.parquet(path)
        _stored[full_key] = path
    return spark.read.parquet(_stored[full_key])
