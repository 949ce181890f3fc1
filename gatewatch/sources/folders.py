"""Shared folders: where streams keep checkpoints and result versions."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, else its warehouse.

    Every executor has to see it: where a cluster names no checkpoint folder, a warehouse
    on a local disk is refused. The folder goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith("file:") and not spark.conf.get("spark.master", "local").startswith(
                "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{base.rstrip('/')}/gatewatch-{uuid.uuid4().hex}"
    path, fs = _path(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, folder: str) -> bool:
    path, fs = _path(spark, folder)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def sub_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below ``folder``; none if it does not exist."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def complete_versions(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers N of the sub-folders ``<prefix>=N`` whose write was committed.

    One listing, however many versions there are.
    """
    path, fs = _path(spark, f"{folder}/{prefix}=*/_SUCCESS")
    found = fs.globStatus(path) or []
    return sorted(int(s.getPath().getParent().getName().split("=", 1)[1]) for s in found)


def make_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.mkdirs(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def file_names(spark: SparkSession, folder: str, ending: str) -> list[str]:
    path, fs = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isFile()]
    return sorted(n for n in names if n.endswith(ending))


def order_files(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Give files modification times, seconds apart, that follow the order of ``names``."""
    now = int(time.time() * 1000)
    for k, name in enumerate(names):
        path, fs = _path(spark, f"{folder}/{name}")
        fs.setTimes(path, now - 1000 * (len(names) - k), -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all once this returns."""
    target, fs = _path(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_texts(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Content of the small files that a pattern matches, by path."""
    path, fs = _path(spark, pattern)
    found = {}
    for status in fs.globStatus(path) or []:
        source = fs.open(status.getPath())
        try:
            found[status.getPath().toString()] = bytes(source.readAllBytes()).decode()
        finally:
            source.close()
    return found


def remove_version(spark: SparkSession, folder: str, prefix: str, number: int) -> None:
    remove_folder(spark, f"{folder}/{prefix}={number}")
