"""Files and folders through Hadoop's FileSystem: outputs that are replaced only when the new
one is whole, and files that become part of a table by moving them. Nothing is read or
copied; the driver handles names only."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from sparkmine.session import delete_path, file_system


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, where = file_system(spark, source)
    if not fs.rename(where, file_system(spark, target)[1]):
        raise OSError(f"can't rename {source} to {target}")


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write(folder)`` into a folder beside ``path``, which then takes its place.

    A job that fails leaves the earlier output as it was, and what it wrote is deleted. The
    swap is two renames: between them ``path`` isn't there, so readers should start before
    or after; if the second fails, the first is taken back. ``path`` may be an input of what
    is written."""
    path = path.rstrip("/")
    new, old = (f"{path}.{kind}-{uuid.uuid4().hex[:12]}" for kind in ("new", "old"))
    try:
        write(new)
    except BaseException:
        delete_path(spark, new)
        raise
    fs, where = file_system(spark, path)
    earlier = fs.exists(where)
    if earlier:
        _rename(spark, path, old)
    try:
        _rename(spark, new, path)
    except BaseException:
        if earlier:
            _rename(spark, old, path)
        delete_path(spark, new)
        raise
    if earlier:
        delete_path(spark, old)
    spark.catalog.refreshByPath(path)  # nothing cached from the old files is used again


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, full path) of the files of a folder, or of one file, by name; hidden ones
    (``_``, ``.``) are none."""
    fs, where = file_system(spark, path)
    found = []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            raise ValueError(f"{path} holds a folder: {name}")
        found.append((name, status.getPath().toString()))
    return sorted(found)


def free_name(name: str, taken: set[str]) -> str:
    """``name``, or with the first free ``_copy_N`` before its extension."""
    stem, extension = os.path.splitext(name)
    n, free = 0, name
    while free in taken:
        n += 1
        free = f"{stem}_copy_{n}{extension}"
    return free


def move_files(spark: SparkSession, source: str, target: str, replace: bool = False) -> list[str]:
    """Move the files of ``source`` (a folder or one file) into the folder ``target`` and
    return their new names. A name that is taken there gets ``_copy_N``. ``replace``: the
    files that ``target`` had are deleted once all others have moved.

    Each move is one rename, so a load that was interrupted goes on with the files that are
    left. A job's ``_SUCCESS`` in ``source`` is deleted; other hidden files stay."""
    moving = data_files(spark, source)
    fs, into = file_system(spark, target)
    fs.mkdirs(into)
    before = data_files(spark, target)
    taken, names = {name for name, _ in before}, []
    for name, where in moving:
        names.append(free_name(name, taken))
        taken.add(names[-1])
        _rename(spark, where, f"{target.rstrip('/')}/{names[-1]}")
    delete_path(spark, f"{source.rstrip('/')}/_SUCCESS")
    if replace:
        for _, where in before:
            delete_path(spark, where)
    return names
