"""Commit markers of a stream's micro-batches.

A batch's files (rows, counters, codes) become valid by one small file,
``_commits/s=<stream>/<batch>.json``, which is written under another name and then renamed.
Readers go by the markers, so they never see half a batch or one that is being written
anew; a batch that is delivered again after its marker is there is skipped.
"""
from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, out_dir: str):
        self.root = f"{out_dir.rstrip('/')}/_commits"
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _file(self, stream: int, batch: int) -> str:
        return f"{self.root}/s={stream}/{batch}.json"

    def read(self, stream: int, batch: int) -> dict[str, Any] | None:
        p = self._path(self._file(stream, batch))
        if not self._fs.exists(p):
            return None
        f = self._fs.open(p)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8"))
        finally:
            f.close()

    def write(self, stream: int, batch: int, state: dict[str, Any]) -> None:
        final = self._path(self._file(stream, batch))
        draft = self._path(f"{self.root}/s={stream}/.{batch}-{uuid.uuid4().hex}")
        f = self._fs.create(draft, True)
        try:
            f.write(bytearray(json.dumps(state).encode()))
        finally:
            f.close()
        if not self._fs.rename(draft, final) and self.read(stream, batch) is None:
            raise OSError(f"the marker {final} could not be written")

    def batches(self, stream: int) -> list[int]:
        """Committed batches of a stream, ascending (names only, no file is opened)."""
        return sorted(int(n[:-5]) for n in self._names(f"{self.root}/s={stream}") if n.endswith(".json") and not n.startswith("."))

    def streams(self) -> list[int]:
        return sorted(int(n[2:]) for n in self._names(self.root) if n.startswith("s="))

    def before(self, stream: int, batch: int) -> dict[str, Any] | None:
        """What the last commit before this batch left: one file is read, however many batches
        there have been."""
        if batch > 0 and (state := self.read(stream, batch - 1)) is not None:
            return state
        for s in reversed([x for x in self.streams() if x <= stream]):
            done = [b for b in self.batches(s) if s < stream or b < batch]
            if done:
                return self.read(s, done[-1])
        return None

    def last(self) -> dict[str, Any] | None:
        streams = self.streams()
        return self.before(streams[-1] + 1, 0) if streams else None

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
