"""Numbered version files on shared storage, written once and never changed.

``commit`` is the only way a version comes into being: the whole text is written aside and then
put under its final name only if that name is free. Two writers that aim at the same number get
it one after the other: the second sees the conflict, builds its text for the next number and tries
again. Readers see complete files only. A file system with an atomic rename (or hard link, for
local paths) is assumed."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tabforge.sources.stage import _read_text, _write_text

MOST_TRIES = 100


class Conflict(RuntimeError):
    """The version exists already."""


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``; False (and no change) if it exists."""
    jvm = spark.sparkContext._jvm
    dst, fs = _path(spark, path)
    if fs.exists(dst):
        return False
    fs.mkdirs(dst.getParent())
    aside = f"{dst.getParent()}/.{dst.getName()}-{uuid.uuid4().hex}"
    _write_text(spark, aside, text)
    src = jvm.org.apache.hadoop.fs.Path(aside)
    try:
        if fs.getUri().getScheme() == "file":               # a rename would replace the file
            local = [jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (dst, src)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            none = spark.sparkContext._gateway.new_array(options, 1)
            none[0] = options.NONE
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(src, dst, none)
        return True
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(src, False)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions in ``folder``, ascending."""
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in names) if m)


def version_file(folder: str, n: int) -> str:
    return f"{folder.rstrip('/')}/v{n:010d}.json"


def read_version(spark: SparkSession, folder: str, n: int | None = None) -> tuple[int, dict] | None:
    """(number, content) of version ``n``, or of the latest; None if there is none."""
    if n is None:
        found = versions(spark, folder)
        if not found:
            return None
        n = found[-1]
    text = _read_text(spark, version_file(folder, n))
    return None if text is None else (n, json.loads(text))


def commit(spark: SparkSession, folder: str, build: Callable[[int, dict | None], dict], tries: int = MOST_TRIES) -> tuple[int, dict]:
    """Add the next version: ``build(number, latest content)`` gives its content, anew after each
    conflict. Raises ``Conflict`` after ``tries`` lost races."""
    for _ in range(tries):
        last = read_version(spark, folder)
        n = last[0] + 1 if last else 1
        content = build(n, last[1] if last else None)
        if put_if_absent(spark, version_file(folder, n), json.dumps(content, default=str)):
            return n, content
    raise Conflict(f"no free version in {folder} after {tries} tries")
