"""Folders of configured datasets, looked up through Hadoop's file systems (so on any
store Spark can read, not only local disks)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def plain_path(spark: SparkSession, path: str) -> str:
    """Absolute path without scheme and authority, not URL-encoded, no slash at its end."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toUri().getPath().rstrip("/")


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does any file match the glob?"""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def dataset_path(spark: SparkSession, path: str, data_dir: str | None = None, config_name: str | None = None,
                 split: str | None = None, revision: str | None = None, what: str = "dataset") -> str:
    """What to read for a configured dataset: ``path[/revision][/data_dir][/config_name]``,
    each of which must be a folder when it is named, and in it the split: a folder of its
    name, or files ``<split>.*`` / ``<split>-*``. Data that isn't divided is the split
    ``train``; any other split that isn't there raises."""
    at = path.rstrip("/")
    for part, name in (("revision", revision), ("data_dir", data_dir), ("config_name", config_name)):
        if name:
            at = f"{at}/{name.strip('/')}"
            if not is_folder(spark, at):
                raise ValueError(f"{what}: {part} {name!r} not found ({at})")
    if not split or not is_folder(spark, at):
        if split not in (None, "", "train"):
            raise ValueError(f"{what}: split {split!r} not found in the single file {at}")
        return at
    if is_folder(spark, f"{at}/{split}"):
        return f"{at}/{split}"
    if matches(spark, f"{at}/{split}[-.]*"):
        return f"{at}/{split}[-.]*"
    divided = any(is_folder(spark, f"{at}/{s}") or matches(spark, f"{at}/{s}[-.]*") for s in ("train", "validation", "val", "test"))
    if split == "train" and not divided:
        return at
    raise ValueError(f"{what}: split {split!r} not found in {at}")
