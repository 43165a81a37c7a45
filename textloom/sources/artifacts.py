"""Build-if-absent artifacts keyed by a canonical hash of *all* parameters."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from typing import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def artifact_path(base: str, name: str, params: dict) -> str:
    key = json.dumps(params, sort_keys=True, default=str)
    digest = hashlib.sha256(key.encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/{name}-{digest}"


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, hpath = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(hpath)) if fs.exists(hpath) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote (scratch tables, failed builds)."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; false if there is one already.  Creation that does not
    overwrite is the one step that file systems and object stores decide for us."""
    fs, hpath = _fs(spark, path)
    try:
        out = fs.create(hpath, False)
    except Py4JJavaError as e:
        if "exist" not in str(e.java_exception).lower():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _named(spark: SparkSession, path: str, patience: float = 10.0) -> str | None:
    """What the pointer says; one that is empty is waited for, as its writer is
    between creating and closing it."""
    fs, hpath = _fs(spark, path)
    until = time.monotonic() + patience
    while fs.exists(hpath):
        size = fs.getFileStatus(hpath).getLen()
        if size:
            lines = spark.read.text(path).collect()  # one short line
            return lines[0][0] if lines else None
        if time.monotonic() > until:
            raise RuntimeError(f"{path} was left empty by a builder that stopped; delete it")
        time.sleep(0.05)
    return None


def materialize(spark: SparkSession, base: str, name: str, params: dict,
                build_fn: Callable[[], DataFrame] | None, partition_by=None) -> DataFrame:
    """Load the artifact for ``params`` if it is there, else build it with
    ``build_fn``.  With ``build_fn=None`` a missing artifact is an error.

    A build goes to a data folder of its own, which never changes again; then the
    pointer ``CURRENT`` is created, exclusively, and names it.  Readers follow the
    pointer, so they see a whole artifact or none, no rename or deletion is needed
    on the way, and of several builders exactly one wins: the others read its data
    and remove theirs.  A builder that dies leaves a folder nobody points to."""
    path = artifact_path(base, name, params)
    pointer = f"{path}/CURRENT"
    found = _named(spark, pointer)
    if found is None:
        if build_fn is None:
            raise FileNotFoundError(f"artifact {name} for {params} not built: {path}")
        mine = f"data-{uuid.uuid4().hex}"
        w = build_fn().write
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(f"{path}/{mine}")
        if _claim(spark, pointer, mine):
            found = mine
        else:
            delete_path(spark, f"{path}/{mine}")
            found = _named(spark, pointer)
    return spark.read.parquet(f"{path}/{found}")
