"""Tables that are changed while they are read: written versions and one pointer to the newest.

A version names the folders its rows are in. A writer puts new rows into folders of its own and then publishes the next
version's number, which only one writer can do; whoever comes second starts again from what the first one has left. Readers
stay with the version they began with, as folders are never written to twice. A write that fails leaves the version as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_POINTERS = "_versions"


@dataclass(frozen=True)
class Version:
    number: int = 0
    #: Folders by part of the table.
    folders: dict[str, list[str]] = field(default_factory=dict)
    #: What else is to be known of the table.
    info: dict = field(default_factory=dict)

    def of(self, parts=None) -> list[str]:
        return [f for p, found in sorted(self.folders.items()) if parts is None or p in parts for f in found]


class _Files:
    """The few calls on files that Spark's readers and writers do not have."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def text(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, file: str, text: str) -> bool:
        """Write the file if it does not exist, all of it or nothing; whether it was this call that wrote it."""
        aside = f"{file}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(aside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self.path(aside), self.path(file), none)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
                raise
            self.fs.delete(self.path(aside), False)
            return False


def current(spark: SparkSession, path: str) -> Version:
    files = _Files(spark, path)
    numbers = [int(n) for n in files.names(f"{path}/{_POINTERS}") if n.isdigit()]
    if not numbers:
        return Version()
    number = max(numbers)
    held = json.loads(files.text(f"{path}/{_POINTERS}/{number:012d}"))
    return Version(number, held["folders"], held["info"])


def read(spark: SparkSession, path: str, parts=None) -> DataFrame | None:
    """The newest version's rows, of some parts or all; None where there are none."""
    folders = current(spark, path).of(parts)
    return spark.read.parquet(*[f"{path}/{f}" for f in folders]) if folders else None


def new_folder() -> str:
    return f"rows-{uuid.uuid4().hex}"


def change(spark: SparkSession, path: str, make: Callable[[Version], Version | None], attempts: int = 20) -> Version:
    """Publish what ``make`` gives: from the newest version the next one, whose folders it has written; None leaves the version as
    it is. It is called again if another writer was first."""
    for _ in range(attempts):
        base = current(spark, path)
        made = make(base)
        if made is None:
            return base
        text = json.dumps({"folders": made.folders, "info": made.info}, sort_keys=True)
        if _Files(spark, path).put(f"{path}/{_POINTERS}/{base.number + 1:012d}", text):
            return replace(made, number=base.number + 1)
    raise RuntimeError(f"{attempts} other versions of {path} came first")


def append(spark: SparkSession, path: str, part: str, rows: Callable[[DataFrame | None], DataFrame | None],
           instead: bool = False) -> DataFrame | None:
    """Add the rows that ``rows`` makes of the newest version of a part, or put them in its place. None adds nothing."""
    def make(base: Version) -> Version | None:
        old = base.folders.get(part, [])
        made = rows(spark.read.parquet(*[f"{path}/{f}" for f in old]) if old else None)
        if made is None:
            return None
        folder = new_folder()
        made.write.parquet(f"{path}/{folder}")
        return replace(base, folders={**base.folders, part: [folder] if instead else [*old, folder]})

    folders = change(spark, path, make).of([part])
    return spark.read.parquet(*[f"{path}/{f}" for f in folders]) if folders else None
