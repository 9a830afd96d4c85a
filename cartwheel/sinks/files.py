"""The few file-system calls a writer needs, on whatever file system the path names."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# calls of the file system at a time
AT_ONCE = 16


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _located(spark, path)
    return fs.exists(where)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds anything besides markers; an empty result leaves only those."""
    fs, where = _located(spark, path)
    return fs.exists(where) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(where))


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _located(spark, path)
    return fs.delete(where, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, where = _located(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of all that lies directly below ``path``."""
    fs, where = _located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    fs, where = _located(spark, path)
    fs.create(where, True).close()


def leaves(spark: SparkSession, path: str) -> list[str]:
    """The folders below ``path`` that hold no folders themselves, relative to it."""
    below = [name for name in subfolders(spark, path) if not name.startswith(("_", "."))]
    deeper = [(name, leaves(spark, f"{path}/{name}")) for name in below]
    return [part for name, inner in deeper for part in ([f"{name}/{x}" for x in inner] or [name])]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder unless its target is there already."""
    fs, there = _located(spark, target)
    if not fs.exists(there):
        fs.mkdirs(there.getParent())
        if not fs.rename(_located(spark, source)[1], there):
            raise OSError(f"{source} could not become {target}")


def each(call: Callable[[SparkSession, str], bool], spark: SparkSession, paths) -> int:
    """Call for every path, several at a time; returns how many calls were true. ``paths`` may be a long iterator."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        done, running = 0, []
        for path in paths:
            running.append(pool.submit(call, spark, path))
            if len(running) == 64 * AT_ONCE:
                done += sum(bool(r.result()) for r in running)
                running = []
        return done + sum(bool(r.result()) for r in running)
