"""Numbered records in a shared folder: who publishes next, and what is current.

A number is claimed by creating a file that must not exist yet, so of two writers one gets
the number and the other the next one. No clock takes part. A writer that is lost between
its claim and its record leaves a number without a record, which readers pass over.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _claimed(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already."""
    place, fs = _place(spark, path)
    fs.mkdirs(place.getParent())
    if fs.getScheme() == "file":
        # Hadoop looks first and creates then on a local disk; Java does both in one step.
        return spark._jvm.java.io.File(fs.makeQualified(place).toUri().getPath()).createNewFile()
    try:
        fs.create(place, False).close()
        return True
    except Py4JJavaError as error:
        if fs.exists(place):
            return False
        raise error


def _numbers(spark: SparkSession, folder: str, suffix: str) -> list[int]:
    place, fs = _place(spark, folder)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(name.removesuffix(suffix)) for name in names if name.endswith(suffix))


def claim(spark: SparkSession, folder: str) -> int:
    """A number that is higher than all before it and that nobody else gets."""
    n = max(_numbers(spark, folder, ".claim"), default=-1) + 1
    while not _claimed(spark, f"{folder}/{n:012d}.claim"):
        n += 1
    return n


def publish(spark: SparkSession, folder: str, record: dict[str, Any]) -> int:
    """Make ``record`` the current one and return its number."""
    n = claim(spark, folder)
    # Written under a name that readers pass over, so that they never see half a record.
    written, fs = _place(spark, f"{folder}/{n:012d}.writing")
    out = fs.create(written, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if not fs.rename(written, _place(spark, f"{folder}/{n:012d}.json")[0]):
        raise OSError(f"record {n} cannot be published in {folder}")
    return n


def read(spark: SparkSession, folder: str, number: int) -> dict[str, Any]:
    place, fs = _place(spark, f"{folder}/{number:012d}.json")
    stream = fs.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def published(spark: SparkSession, folder: str) -> Iterator[tuple[int, dict[str, Any]]]:
    """Numbers and records, the current one first."""
    for number in reversed(_numbers(spark, folder, ".json")):
        yield number, read(spark, folder, number)


def current(spark: SparkSession, folder: str) -> dict[str, Any] | None:
    """The record with the highest number; None if there is none."""
    return next((record for _, record in published(spark, folder)), None)


def retract(spark: SparkSession, folder: str, number: int) -> None:
    """Remove a record. Its claim stays, so that the number is not given again."""
    place, fs = _place(spark, f"{folder}/{number:012d}.json")
    fs.delete(place, False)
