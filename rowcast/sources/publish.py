"""Publishing: a folder is written beside its place and put there once complete.

Spark's own overwrite deletes the old folder before the new one is written, so
a failing job leaves nothing. Here the old content stays readable until the new
one is complete, whichever way it is put in place:

* ``switch``: the new folder is written as a hidden sibling and renamed into
  place. For file systems whose renames are atomic (HDFS, local disks). Between
  the two renames nothing lies at the path; a writer that dies there leaves the
  old folder under a hidden name, from which :func:`settle` restores it.
* ``manifest``: every version is a folder of its own below the path, and one
  small commit file, written last and never changed, makes it the current one.
  Nothing is renamed, so it fits object stores. Readers go through
  :func:`current`; a reader that still has the version before keeps it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

COMMITS = "_commits"
VERSION = "version-"
WAYS = ("switch", "manifest")
KEPT_VERSIONS = 2  # the current one and the one its readers may still have open


def place_of(spark: SparkSession, path: str):
    """The file system of ``path`` and its Hadoop path."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def child(spark: SparkSession, parent, name: str):
    """The Hadoop path of ``name`` below ``parent``."""
    return spark._jvm.org.apache.hadoop.fs.Path(parent, name)


def _names(fs, folder) -> list[str]:
    return sorted(status.getPath().getName() for status in fs.listStatus(folder)) if fs.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is published at ``path``."""
    settle(spark, path)
    fs, hpath = place_of(spark, path)
    if not fs.exists(hpath):
        return False
    below = _names(fs, hpath) if fs.getFileStatus(hpath).isDirectory() else []
    only_staged = bool(below) and all(n.startswith(VERSION) or n == COMMITS for n in below)
    return not only_staged or bool(versions(spark, path))


def refuse_existing(spark: SparkSession, path: str) -> None:
    """Raise if something is published at ``path``."""
    if exists(spark, path):
        raise FileExistsError(f"{path} already exists")


def _replaced_prefix(hpath) -> str:
    return f"_{hpath.getName()}.replaced-"


def settle(spark: SparkSession, path: str) -> None:
    """Put back the old folder of a writer that died between its two renames."""
    fs, hpath = place_of(spark, path)
    parent = hpath.getParent()
    if parent is None or fs.exists(hpath):
        return
    left = [n for n in _names(fs, parent) if n.startswith(_replaced_prefix(hpath))]
    if left:
        fs.rename(child(spark, parent, left[-1]), hpath)


@contextmanager
def staged(spark: SparkSession, path: str, commit: str = "switch") -> Iterator[str]:
    """Gives the folder to write to; leaving the block publishes it at ``path``.

    An exception in the block deletes what was written and leaves ``path`` as
    it was.
    """
    if commit not in WAYS:
        raise ValueError(f"commit must be one of {WAYS}, not {commit!r}")
    settle(spark, path)
    fs, target = place_of(spark, path)
    there = fs.exists(target)
    mark = uuid.uuid4().hex
    if commit == "switch":
        stage = child(spark, target.getParent(), f"_{target.getName()}.staged-{mark}")
    else:
        stage = child(spark, target, f"{VERSION}{mark}")
    try:
        yield stage.toString()
        if commit == "switch":
            _switch(spark, fs, stage, target)
        else:
            _commit(spark, fs, target, stage.getName())
    except BaseException:
        fs.delete(stage, True)
        if not there and fs.exists(target) and not _names(fs, target):
            fs.delete(target, False)  # made for the version that failed
        raise


def _switch(spark: SparkSession, fs, stage, target) -> None:
    old = None
    if fs.exists(target):
        old = child(spark, target.getParent(), f"{_replaced_prefix(target)}{uuid.uuid4().hex}")
        _move(fs, target, old)
    try:
        _move(fs, stage, target)
    except BaseException:
        if old is not None:
            _move(fs, old, target)
        raise
    if old is not None:
        fs.delete(old, True)


def _move(fs, source, target) -> None:
    """Rename or raise: a file system may do either when it cannot."""
    try:
        moved = fs.rename(source, target)
    except Py4JJavaError as error:
        raise OSError(f"cannot move {source} to {target}") from error
    if not moved:
        raise OSError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, fs, file) -> str:
    """The content of one small file."""
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, fs, file, text: str) -> None:
    """One small file, replacing what was there."""
    _put(fs.create(file, True), text)


def _put(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """``(commit file, version folder)`` of a path published by manifest, oldest
    first; none for any other. A commit file that was cut off does not count."""
    fs, target = place_of(spark, path)
    folder = child(spark, target, COMMITS)
    out = []
    for name in _names(fs, folder):
        text = read_text(spark, fs, child(spark, folder, name)) if name.isdigit() else ""
        if text.endswith("\n"):
            out.append((name, text.strip()))
    return out


def _commit(spark: SparkSession, fs, target, version: str) -> None:
    path, folder = target.toString(), child(spark, target, COMMITS)
    taken = [n for n in _names(fs, folder) if n.isdigit()]
    number = int(taken[-1]) + 1 if taken else 0
    while True:  # another writer may take the same number first
        file = child(spark, folder, f"{number:012d}")
        try:
            stream = fs.create(file, False)
            break
        except Exception:
            if not fs.exists(file):
                raise
            number += 1
    _put(stream, f"{version}\n")
    for name, old in versions(spark, path)[:-KEPT_VERSIONS]:
        fs.delete(child(spark, target, old), True)
        fs.delete(child(spark, folder, name), False)
    for name in _names(fs, target):  # what was published here by switch before
        if not name.startswith(VERSION) and name != COMMITS:
            fs.delete(child(spark, target, name), True)


def current(spark: SparkSession, path: str) -> str:
    """Where the published content of ``path`` lies: the version that the last
    commit names, or ``path`` itself when it is not published by manifest."""
    settle(spark, path)
    found = versions(spark, path)
    return f"{path.rstrip('/')}/{found[-1][1]}" if found else path
