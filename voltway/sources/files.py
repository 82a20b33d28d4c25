"""Files as Spark sees them: listing, small texts, digests and a log of numbered states.

Everything goes through Hadoop's file systems, so a path that only Spark's
readers can open is as good as a local one.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to so many bytes are digested as one value in a task; larger ones are streamed.
WHOLE_BYTES = 256 << 20
EMPTY = hashlib.sha256().hexdigest()
COMMITTED = re.compile(r"(\d{10})\.json")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a new local one where that is unset and the master is local (tests)."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-voltway-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


def hadoop_path(spark: SparkSession, path: str):
    """A path of Hadoop's and its file system, as Spark's writers see it."""
    own = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass(frozen=True, order=True)
class Listed:
    path: str
    name: str
    bytes: int
    modified: int


def listed(spark: SparkSession, folder: str, suffix: str = "") -> list[Listed]:
    """The files of a folder in the order of their names; none where there is no folder."""
    own, system = hadoop_path(spark, folder)
    found = [f for f in system.listStatus(own) if f.isFile()] if system.exists(own) else []
    return sorted((Listed(f.getPath().toString(), f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found if f.getPath().getName().endswith(suffix)), key=lambda f: f.name)


def one(spark: SparkSession, path: str) -> Listed:
    own, system = hadoop_path(spark, path)
    f = system.getFileStatus(own)
    return Listed(f.getPath().toString(), f.getPath().getName(), f.getLen(), f.getModificationTime())


def folders(spark: SparkSession, folder: str) -> list[str]:
    own, system = hadoop_path(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(own) if f.isDirectory()) if system.exists(own) else []


def exists(spark: SparkSession, path: str) -> bool:
    own, system = hadoop_path(spark, path)
    return system.exists(own)


def delete(spark: SparkSession, path: str) -> None:
    own, system = hadoop_path(spark, path)
    system.delete(own, True)


def text(spark: SparkSession, path: str) -> str:
    own, system = hadoop_path(spark, path)
    stream = system.open(own)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line, without the mark that some writers begin a file with; None of an empty file."""
    own, system = hadoop_path(spark, path)
    stream = system.open(own)
    try:
        java = spark._jvm.java.io
        line = java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return line if line is None else line.lstrip("﻿")


def put(spark: SparkSession, path: str, content: str) -> None:
    own, system = hadoop_path(spark, path)
    stream = system.create(own, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to a name that nothing has yet; False if something has it."""
    jvm = spark._jvm
    (old, _), (new, _) = hadoop_path(spark, source), hadoop_path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(old, new, none)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def streamed_digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any size, read in the JVM a block at a time."""
    own, system = hadoop_path(spark, path)
    stream = system.open(own)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def digests(spark: SparkSession, files: list[Listed]) -> dict[str, str]:
    """name -> SHA-256 of the files of one folder."""
    small = [f for f in files if 0 < f.bytes <= WHOLE_BYTES]
    found = {f.name: EMPTY for f in files if not f.bytes}
    if small:
        whole = spark.read.format("binaryFile").load([glob_safe(f.path) for f in small])
        rows = whole.select("path", F.sha2("content", 256).alias("sha256")).collect()  # a row a file
        by_name = {spark._jvm.org.apache.hadoop.fs.Path(r["path"]).getName(): r["sha256"] for r in rows}
        found |= {f.name: by_name[f.name] for f in small}
    return found | {f.name: streamed_digest(spark, f.path) for f in files if f.bytes > WHOLE_BYTES}


def glob_safe(path: str) -> str:
    """The path with what Spark's readers take for patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class Log:
    """Numbered JSON states in a folder; the newest holds.

    A state is written beside and committed by a rename to the next number, which
    fails if another writer took that number first; ``update`` then applies its
    change to what the other wrote. A reader never sees half a state.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:010d}.json"

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for f in listed(self.spark, self.folder, ".json") if (m := COMMITTED.fullmatch(f.name)))

    def state(self, number: int) -> dict:
        return json.loads(text(self.spark, self.path(number))) if number else {}

    def latest(self) -> tuple[int, dict]:
        """The newest number and its state; 0 and nothing before the first."""
        number = max(self.numbers(), default=0)
        return number, self.state(number)

    def commit(self, number: int, state: dict) -> bool:
        draft = f"{self.folder}/.{uuid.uuid4().hex}.draft"
        put(self.spark, draft, json.dumps(state, indent=1, sort_keys=True))
        done = renamed(self.spark, draft, self.path(number))
        if not done:
            delete(self.spark, draft)
        return done

    def update(self, change: Callable[[dict], dict], tries: int = 20) -> tuple[int, dict]:
        """Commit ``change`` of the newest state, however many others commit meanwhile."""
        for _ in range(tries):
            number, state = self.latest()
            state = change(state)
            if self.commit(number + 1, state):
                return number + 1, state
        raise RuntimeError(f"{tries} others committed to {self.folder} meanwhile")
