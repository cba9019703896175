"""Commits of folders: renames, written down before the first is done, so that a run that dies is completed by the next.

New files lie aside when a commit begins.  The journal lists what takes whose place; every step can be repeated, so that it
is enough to go through all of them again.  The journal goes last.  Readers see a commit's renames one by one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

JOURNAL = "_commit.json"
Pair = tuple[str, str | None]


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if it is not there."""
    fs, p = file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = file_system(spark, path).create(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    stream.write(bytearray(text.encode()))
    stream.close()


def rename(spark: SparkSession, a: str, b: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        fs = file_system(spark, a)
        fs.mkdirs(path(b).getParent())
        renamed = fs.rename(path(a), path(b))
    except Py4JJavaError as e:
        raise OSError(f"{a} could not be renamed to {b}") from e
    if not renamed:
        raise OSError(f"{a} could not be renamed to {b}")


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def commit(spark: SparkSession, folder: str, pairs: Sequence[Pair], then: Sequence[str] = ()) -> None:
    """Each (a, b): a takes the place of b, which goes if it is there; with b None, a goes.  then: what is deleted afterwards.

    An error before the end undoes what was done; a run that dies leaves the journal of `folder` to recover().
    """
    for a, _ in pairs:
        if not exists(spark, a):
            raise OSError(f"{a} is not there, so it can't be renamed")
    gone = f"{folder.rstrip('/')}/.old-{uuid.uuid4().hex}"
    moves: list[tuple[str, str]] = []
    for i, (a, b) in enumerate(pairs):
        old = f"{gone}/{i}"
        if b is None:
            moves.append((a, old))
            continue
        if exists(spark, b):
            moves.append((b, old))
        moves.append((a, b))
    journal = f"{folder.rstrip('/')}/{JOURNAL}"
    aside = f"{folder.rstrip('/')}/.journal-{uuid.uuid4().hex}"
    file_system(spark, folder).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(gone))
    write_text(spark, aside, json.dumps({"moves": moves, "deletes": [gone, *then]}))
    rename(spark, aside, journal)
    done: list[tuple[str, str]] = []
    try:
        for a, b in moves:
            move(spark, a, b)
            done.append((a, b))
    except Exception:
        for a, b in reversed(done):
            rename(spark, b, a)
        delete(spark, journal)
        delete(spark, gone)
        raise
    finish(spark, journal, [gone, *then])


def move(spark: SparkSession, a: str, b: str) -> None:
    """Unless it has been done: then b is there, or a no longer."""
    if exists(spark, a) and not exists(spark, b):
        rename(spark, a, b)


def finish(spark: SparkSession, journal: str, deletes: Sequence[str]) -> None:
    for path in deletes:
        delete(spark, path)
    delete(spark, journal)


def recover(spark: SparkSession, folder: str, told: Callable[[str], None] = lambda _: None) -> bool:
    """Completes a commit that a run has left; whether there was one."""
    journal = f"{folder.rstrip('/')}/{JOURNAL}"
    text = read_text(spark, journal)
    if text is None:
        return False
    plan = json.loads(text)
    for a, b in plan["moves"]:
        move(spark, a, b)
    finish(spark, journal, plan["deletes"])
    told(journal)
    return True
