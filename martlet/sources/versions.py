"""Versioned publishing: data folders that never change, and one numbered pointer file that says which are current.

A publisher writes new folders first and then one pointer ``_versions/<n>``; readers follow the pointer of the highest number. Nothing that a reader may have
open is moved or overwritten, all tables of a version become current at once, and two publishers that start from the same version
cannot both succeed: the second finds its number taken.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from martlet.sources.landing import _file_system


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _file_system(spark, f"{root}/_versions")
    if not fs.exists(folder):
        return []
    return sorted(int(st.getPath().getName()) for st in fs.listStatus(folder) if st.getPath().getName().isdigit())


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the current version; (0, {}) before the first."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, {}
    lines = spark.read.text(f"{root}/_versions/{numbers[-1]}").collect()  # one small pointer file
    return numbers[-1], json.loads("".join(r[0] for r in lines))


def publish(spark: SparkSession, root: str, state: dict, after: int) -> int:
    """Make ``state`` the version after ``after``; raises if another publisher was faster."""
    fs, staged = _file_system(spark, f"{root}/_versions/.{uuid.uuid4().hex}")
    _, target = _file_system(spark, f"{root}/_versions/{after + 1}")
    fs.mkdirs(staged.getParent())
    out = fs.create(staged, False)
    try:
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(staged, target):
        fs.delete(staged, False)
        raise RuntimeError(f"version {after + 1} of {root} was published by another writer")
    return after + 1


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return bool(fs.exists(path))


def new_folder(root: str, name: str) -> str:
    """A fresh folder for one table of a version to come."""
    return f"{root}/{name}/{uuid.uuid4().hex}"
