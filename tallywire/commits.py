"""What has been committed to a folder: one small file for each number, written last.

Data goes to folders or files that nobody else names; an entry of the log then says, in one
step, which of them count. Whatever no entry names was never written, as far as readers know.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from typing import Any, Protocol

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

# Entries up to a multiple of this are also kept together, in one file.
FOLD = 64
_LOG = "_commits"
_DIGITS = 20


class Folder(Protocol):
    """Small files of one folder, on whatever file system it is."""

    def names(self) -> list[str]: ...
    def read(self, name: str) -> bytes: ...
    def write(self, name: str, content: bytes) -> None: ...
    def remove(self, name: str) -> None: ...


class HadoopFolder:
    """A folder reached through the session, by any scheme the cluster knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = path
        location = self._at("")
        self._fs = location.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}" if name else self._path)

    def names(self) -> list[str]:
        if not self._fs.exists(self._at("")):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._at(""))]

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def fingerprint(self) -> str:
        """A text that is another one as soon as files come, go or are written anew."""
        about = sorted(f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}"
                       for s in self._fs.listStatus(self._at("")) if s.isFile())
        return hashlib.sha256("\n".join(about).encode()).hexdigest()

    def read(self, name: str) -> bytes:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def write(self, name: str, content: bytes) -> None:
        """All of it or nothing: under another name first."""
        hidden = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        try:
            stream.write(content)
        finally:
            stream.close()
        if not self._fs.rename(hidden, self._at(name)):
            self._fs.delete(hidden, False)
            raise FileExistsError(f"{self._path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class ArrowFolder:
    """The same for code without a session: tasks, and data sources on the driver."""

    def __init__(self, uri: str):
        plain = re.fullmatch("(?:file:)?(/*[^:]*)", uri)
        if plain:
            self._fs, self._path = pafs.LocalFileSystem(), os.path.abspath(re.sub("^/+", "/", plain[1]))
        else:
            self._fs, self._path = pafs.FileSystem.from_uri(uri)
        self._fs.create_dir(self._path, recursive=True)

    def names(self) -> list[str]:
        return [info.base_name for info in self._fs.get_file_info(pafs.FileSelector(self._path))]

    def read(self, name: str) -> bytes:
        with self._fs.open_input_stream(f"{self._path}/{name}") as stream:
            return stream.read()

    def move(self, name: str, to: ArrowFolder) -> None:
        """To another folder of the same file system."""
        self._fs.move(f"{self._path}/{name}", f"{to._path}/{name}")

    def create(self, name: str):
        """A stream to write a file to."""
        return self._fs.open_output_stream(f"{self._path}/{name}")

    def write(self, name: str, content: bytes) -> None:
        """All of it or nothing: under another name first."""
        hidden = f"{self._path}/.{name}-{uuid.uuid4().hex}"
        with self._fs.open_output_stream(hidden) as stream:
            stream.write(content)
        self._fs.move(hidden, f"{self._path}/{name}")

    def remove(self, name: str) -> None:
        info = self._fs.get_file_info(f"{self._path}/{name}")
        if info.type == pafs.FileType.Directory:
            self._fs.delete_dir(info.path)
        elif info.type == pafs.FileType.File:
            self._fs.delete_file(info.path)


class CommitLog:
    """Numbered entries beside the data they name. One writer at a time, any number of readers.

    Entries are found by their file names. All entries up to every ``FOLD``-th are written again as
    one file, so that a reader opens a bounded number of files, however long the log is.
    """

    def __init__(self, folder: Folder):
        self._folder = folder

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> CommitLog:
        return cls(HadoopFolder(spark, f"{path}/{_LOG}"))

    @classmethod
    def at(cls, uri: str) -> CommitLog:
        return cls(ArrowFolder(f"{uri}/{_LOG}"))

    def _numbers(self, ending: str) -> list[int]:
        return sorted(int(name[:_DIGITS]) for name in self._folder.names()
                      if name.endswith(ending) and not name.startswith("."))

    def last(self) -> int:
        """The highest number committed, or -1."""
        numbers = self._numbers(".json")
        return numbers[-1] if numbers else -1

    def get(self, number: int) -> dict[str, Any]:
        return json.loads(self._folder.read(f"{number:0{_DIGITS}d}.json"))

    def latest(self) -> dict[str, Any] | None:
        number = self.last()
        return None if number < 0 else self.get(number)

    def entries(self) -> dict[int, dict[str, Any]]:
        """All entries by number."""
        folded = self._numbers(".all")
        known: dict[int, dict[str, Any]] = {}
        if folded:
            lines = self._folder.read(f"{folded[-1]:0{_DIGITS}d}.all").decode().splitlines()
            known = {number: entry for number, entry in map(json.loads, lines)}
        singles = self._numbers(".json")
        return known | {n: self.get(n) for n in singles if not folded or n > folded[-1]}

    def put(self, number: int, entry: dict[str, Any]) -> None:
        """Commit. Numbers grow; one that isn't new changes nothing, as a batch may come again."""
        if number <= self.last():
            return
        self._folder.write(f"{number:0{_DIGITS}d}.json", json.dumps(entry).encode())
        if number % FOLD == FOLD - 1:
            lines = [json.dumps([n, e]) for n, e in sorted(self.entries().items())]
            folded = f"{number:0{_DIGITS}d}.all"
            if folded not in self._folder.names():
                self._folder.write(folded, "\n".join(lines).encode())
            # The last entry stays as a file of its own, as the newest is looked up by name.
            for old in self._numbers(".json"):
                if old < number - FOLD:
                    self._folder.remove(f"{old:0{_DIGITS}d}.json")
            for old in self._numbers(".all")[:-2]:
                self._folder.remove(f"{old:0{_DIGITS}d}.all")
