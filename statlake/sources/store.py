"""Small files of a lake on any Hadoop file system, and turns that writers take with nothing but them.

Object stores put, list and delete, but create no file "only if it is not there". `Turn` needs no more:
each contender puts a marker of its own and lists the markers afterwards. One that sees an earlier
marker gives up. One that sees later markers waits until they are gone: their owners either saw the
earlier one, and give up, or did not, and finish first. So of two contenders never both have the turn, and
as later ones never wait, no one waits for ever. Markers are ordered by the time in their names; one that
is older than the lease belongs to a contender that died.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def new_id() -> str:
    """An identifier that sorts by time."""
    return f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:12]}"


def age_s(identifier: str) -> float:
    """Seconds since ``new_id`` made an identifier."""
    return time.time() - int(identifier.partition("-")[0]) / 1e6


class Store:
    """Files by their full paths."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, ascending, without hidden ones; none if it is not there."""
        system, place = self._at(folder)
        if not system.exists(place):
            return []
        try:
            found = system.listStatus(place)
        except Py4JJavaError as error:  # it went in between
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return []
            raise
        names = (status.getPath().getName() for status in found)
        return sorted(n for n in names if not n.startswith("."))

    def put(self, path: str, text: str = "") -> None:
        """Write a whole file; it has its name only when it is complete."""
        system, place = self._at(path)
        parent, name = path.rsplit("/", 1)
        part = self._jvm.org.apache.hadoop.fs.Path(f"{parent}/.{name}.{uuid.uuid4().hex[:8]}")
        out = system.create(part, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not system.rename(part, place):
            system.delete(part, False)
            raise FileExistsError(path)

    def text(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        """Remove a file or a folder with all it holds; nothing happens if it is not there."""
        system, place = self._at(path)
        system.delete(place, True)


class Turn:
    """The right to do something that only one contender may do at a time, by markers in a folder."""

    def __init__(self, store: Store, folder: str, name: str | None = None, lease_s: float = 600, pause_s: float = 0.2):
        self.store, self.folder, self.name = store, folder, name or new_id()
        self.lease_s, self.pause_s = lease_s, pause_s

    def _others(self) -> list[str]:
        names = self.store.names(self.folder)
        return [n for n in names if n != self.name and age_s(n) < self.lease_s]

    def take(self, settled: Callable[[], bool] = lambda: False) -> bool:
        """Whether this contender has the turn; it is released if not. ``settled`` tells, once no
        other contender is left, whether one of them did what the turn is for."""
        self.store.put(f"{self.folder}/{self.name}")
        others = self._others()
        if any(other < self.name for other in others):
            self.release()
            return False
        while any(other in others for other in self._others()):
            time.sleep(self.pause_s)
        if settled() or not self.holds():
            self.release()
            return False
        return True

    def holds(self) -> bool:
        """Whether enough of the lease is left to finish; others take the turn for free after it."""
        return age_s(self.name) < self.lease_s / 2

    def release(self) -> None:
        self.store.delete(f"{self.folder}/{self.name}")
