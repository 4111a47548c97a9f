"""Small reads and writes through Spark's own file-system client, so any store that Spark can use will do.

Of data files only the first record of a text file and the footer of a Parquet file
are read here, for a bounded batch of paths and several at a time; whole files are
always read by Spark's readers, in tasks. Notes (schemas, markers) are small files
that appear whole, under names of their own, and are never overwritten.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Files opened at the same time by the driver.
AT_ONCE = 16


def literal(path: str) -> str:
    """A path that Spark's readers take as it is: characters of file patterns are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def norm(path: str) -> str:
    """Local paths and file: URIs compare equal."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            path = path[len(prefix) :]
            break
    return "/" + path.lstrip("/") if path.startswith("/") else path


def is_folder(spark: SparkSession, path: str) -> bool:
    target, fs = _open(spark, path)
    return fs.getFileStatus(target).isDirectory()


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The part files of an extract that is a folder; a file is its only part."""
    target, fs = _open(spark, path)
    if not fs.getFileStatus(target).isDirectory():
        return [path]
    found = [s.getPath() for s in fs.listStatus(target) if s.isFile() and s.getPath().getName().startswith("part-")]
    return sorted(f"{path}/{p.getName()}" for p in found)


def readable(spark: SparkSession, paths: list[str]) -> list[str]:
    """What Spark's readers take for these extracts: files as they are, of folders the part files."""
    folders = for_each(paths, lambda p: is_folder(spark, p))
    return [literal(p) + "/part-*" if folders[p] else literal(p) for p in paths]


def for_each(paths: Iterable[str], work: Callable) -> dict:
    """path -> ``work(path)``, a few at a time."""
    paths = list(paths)
    with ThreadPoolExecutor(max(1, min(AT_ONCE, len(paths)))) as pool:
        return dict(zip(paths, pool.map(work, paths)))


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first ``size`` bytes of a file, or all of a smaller one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def parquet_schema(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """(schema text, problem) from a Parquet footer. A store that fails is raised, a damaged file is not."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.parquet.hadoop
    try:
        file = hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = hadoop.ParquetFileReader.open(file)
    except Py4JJavaError as error:
        cause = error.java_exception
        text = cause.toString()
        if "arquet" in text or cause.getClass().getName() in ("java.io.EOFException", "java.lang.RuntimeException"):
            return None, f"unreadable: {text.splitlines()[0][:200]}"
        raise
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString(), None
    finally:
        reader.close()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below a folder, without hidden ones; none if it is missing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    found = [s.getPath() for s in fs.listStatus(target) if s.isDirectory()]
    return [p.toString() for p in found if not p.getName().startswith(("_", "."))]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run or a merged ledger wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_note(spark: SparkSession, folder: str, text: str) -> str:
    """A new small file in ``folder``; it has its name only once it is whole. Later notes have greater names."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    hidden, fs = _open(spark, f"{folder}/.{name}")
    shown, _ = _open(spark, f"{folder}/{name}")
    stream = fs.create(hidden)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, shown):
        raise OSError(f"cannot write {shown}")
    return name


def notes(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name -> text of the notes in ``folder``, oldest first."""
    target, fs = _open(spark, folder)
    if not fs.exists(target):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile())
    names = [n for n in names if not n.startswith((".", "_"))]
    return {n: head(spark, f"{folder}/{n}", 64 << 20).decode() for n in names}


# --- versions of a table -----------------------------------------------------------

PUBLISHED = "_published"


def new_version(folder: str) -> str:
    """A folder for the next version of a table; readers do not see it before ``publish``."""
    return f"{folder.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Published versions, oldest first."""
    found = []
    for version in sorted(child_folders(spark, folder)):
        mark, fs = _open(spark, f"{version}/{PUBLISHED}")
        if fs.exists(mark):
            found.append(version)
    return found


def publish(spark: SparkSession, version: str, keep: int = 2) -> None:
    """Make a written version the current one, and remove all but the last ``keep``."""
    mark, fs = _open(spark, f"{version}/{PUBLISHED}")
    fs.create(mark).close()
    for old in versions(spark, version.rsplit("/", 1)[0])[:-keep]:
        remove(spark, old)
