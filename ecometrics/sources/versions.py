"""Tables whose current state is named by one small file.

A table is a folder.  Every write puts its rows into a new version folder and then names the folders that make up the
table in a file of its own below ``_versions``, numbered upwards; readers follow the highest number.  The file is
written aside and renamed, so it is there whole or not at all: a writer killed at any moment leaves the table as it was
or as it was to be.  The folders that the last two numbers name are kept for readers that have begun; older ones, and
what killed writers left, go with the next write.  One writer at a time is assumed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION, BUCKET = "tableversion", "keybucket"
KEPT = 2


class State(NamedTuple):
    """What a numbered file says; number 0 is a table without any."""

    number: int
    folders: tuple[str, ...]
    schema: T.StructType | None
    buckets: int = 0


class Files:
    """The file system of a table's folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.system = self.place("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def place(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        if not self.system.exists(self.place(folder)):
            return []
        return [x.getPath().getName() for x in self.system.listStatus(self.place(folder))]

    def read(self, name: str) -> str:
        stream = self.system.open(self.place(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.place(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.system.delete(self.place(name), True)

    def size(self, name: str) -> int:
        return self.system.getContentSummary(self.place(name)).getLength()


def numbers(files: Files) -> list[int]:
    return sorted(int(x.removesuffix(".json")) for x in files.names("_versions") if re.fullmatch(r"\d{9}\.json", x))


def described(files: Files, number: int) -> State:
    said = json.loads(files.read(f"_versions/{number:09d}.json"))
    return State(number, tuple(said["folders"]), T.StructType.fromJson(said["schema"]), said["buckets"])


def current(spark: SparkSession, path: str) -> State:
    files = Files(spark, path)
    known = numbers(files)
    return described(files, known[-1]) if known else State(0, (), None)


def new_folder(state: State) -> str:
    return f"{VERSION}={state.number + 1:09d}-{uuid.uuid4().hex[:8]}"


def committing(files: Files, state: State) -> Iterator[str]:
    """Make ``state`` the current one, step by step; a step's name is handed out when it is done."""
    aside = f"_versions/.{uuid.uuid4().hex}"
    said = {"folders": state.folders, "schema": state.schema.jsonValue(), "buckets": state.buckets}
    files.write(aside, json.dumps(said))
    yield "described"
    if not files.system.rename(files.place(aside), files.place(f"_versions/{state.number:09d}.json")):
        raise OSError(f"version {state.number} of {files.root} could not be named")
    yield "committed"
    kept = numbers(files)[-KEPT:]
    named = {folder for number in kept for folder in described(files, number).folders}
    for name in files.names():
        if name.startswith(f"{VERSION}=") and name not in named:
            files.delete(name)
    for number in numbers(files)[:-KEPT]:
        files.delete(f"_versions/{number:09d}.json")
    yield "cleaned"


def read(spark: SparkSession, path: str, state: State) -> DataFrame:
    """The rows of a state, with the columns VERSION and (of bucketed tables) BUCKET beside the table's own."""
    root = path.rstrip("/")
    reader = spark.read.schema(state.schema).option("basePath", root)
    return reader.parquet(*[f"{root}/{folder}" for folder in state.folders])
