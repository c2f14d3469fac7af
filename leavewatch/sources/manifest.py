"""A table as a set of stored folders, named by manifests that are swapped in one step.

Writers first store what is new in folders of their own, which no reader looks
at, and then add a manifest that names all folders that count from now on. The
manifest of version n is a file that can be made once only: of two writers who
saw version n - 1 one gets through, and the other looks again and starts from
the newer state. Readers take the latest manifest, so they see the old state or
the new one. A writer who dies before the swap leaves folders that nobody
reads; :meth:`Manifest.sweep` removes them.

Wants a file system that renames in one step and refuses to replace, as HDFS
and local ones do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

State = dict[str, Any]


class Manifest:
    """Versions of a state (JSON) below a path; version 0 is the empty state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._settings = spark.sparkContext._jsc.hadoopConfiguration()

    def _place(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._place("").getFileSystem(self._settings)

    def names(self, folder: str = "") -> list[str]:
        """What is stored directly below a folder."""
        files, place = self._files(), self._place(folder)
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def read(self) -> tuple[int, State]:
        """The latest version and its state."""
        versions = [int(n[1:-5]) for n in self.names("manifest") if n.startswith("v") and n.endswith(".json")]
        if not versions:
            return 0, {}
        latest = max(versions)
        stream = self._files().open(self._place(f"manifest/v{latest}.json"))
        try:
            return latest, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def swap(self, version: int, state: State) -> bool:
        """Make the state version ``version``; False if that version is there already."""
        files, staged = self._files(), self._place(f"manifest/.{uuid.uuid4().hex}")
        stream = files.create(staged, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._place("").toUri(), self._settings)
        no_options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(staged, self._place(f"manifest/v{version}.json"), no_options)
        except Py4JJavaError as refused:
            files.delete(staged, False)
            if "FileAlreadyExistsException" not in refused.java_exception.getClass().getName():
                raise
            return False
        return True

    def change(self, step: Callable[[State], State | None], attempts: int = 50) -> tuple[int, State]:
        """Swap in ``step(latest state)``; again from the newer state whenever another writer was first.

        A step that returns None changes nothing.
        """
        for attempt in range(attempts):
            version, state = self.read()
            wanted = step(state)
            if wanted is None or self.swap(version + 1, wanted):
                return (version, state) if wanted is None else (version + 1, wanted)
            time.sleep(0.02 * min(attempt, 10))
        raise TimeoutError(f"{attempts} other writers were first")

    def fresh_folder(self, label: str) -> str:
        """Name, below the path, of a folder that no one else writes to."""
        return f"data/{label}={uuid.uuid4().hex}"

    def full(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def sweep(self, named: set[str]) -> list[str]:
        """Delete every data folder that is not among the named ones. Only where no one writes."""
        gone = [n for n in self.names("data") if f"data/{n}" not in named]
        for name in gone:
            self._files().delete(self._place(f"data/{name}"), True)
        return gone
