"""Numbered manifests: what one of them names becomes visible as a whole."""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_manifests"
_NAME = re.compile(r"^([0-9]{12})\.json$")


class Conflict(RuntimeError):
    """Another writer has published the same number."""


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def remove(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def folders(spark: SparkSession, name: str) -> list[str]:
    """Names of what lies directly below a folder; none where it is missing."""
    path, fs = _path(spark, name)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The published numbers, ascending."""
    return [int(m[1]) for m in map(_NAME.match, folders(spark, f"{root}/{FOLDER}")) if m]


def load(spark: SparkSession, root: str, number: int) -> dict:
    """The manifest of a number; one that is no JSON object is an error."""
    name = f"{root}/{FOLDER}/{number:012d}.json"
    path, fs = _path(spark, name)
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        content = json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError(f"{name} is no manifest: {e}") from e
    if not isinstance(content, dict):
        raise ValueError(f"{name} is no manifest: not an object")
    return content


def publish(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Write a manifest beside its place and move it there; a number is published once."""
    folder, fs = _path(spark, f"{root}/{FOLDER}")
    fs.mkdirs(folder)
    staged, _ = _path(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(content, sort_keys=True), "utf-8"))
    out.close()
    target, _ = _path(spark, f"{root}/{FOLDER}/{number:012d}.json")
    jvm = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    context = jvm.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)
    except Py4JJavaError as e:
        fs.delete(staged, False)
        if fs.exists(target):
            raise Conflict(f"{root}: number {number} is published already") from e
        raise


def withdraw(spark: SparkSession, root: str, number: int) -> None:
    remove(spark, f"{root}/{FOLDER}/{number:012d}.json")
