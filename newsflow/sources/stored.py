"""A stored table with a log: what a reader sees is what the log lists, batch by batch.

Data lies in ``run=<run>/batch_id=<n>/try=<unique>/date=<day>`` under the table's path. A batch
counts from the moment its entry is in ``_log``, which is written last and in one move; folders of
writes that are going on or have failed are in no entry and are never read. Entries of small batches
are merged per date: the entry of a merge adds the new folder and takes the old ones out at once.
All file work goes through Hadoop's file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LOG = "_log"
# Bytes of a file after merging, and how many folders of a date are merged at once at least.
TARGET_BYTES = 128 << 20
LEAST_FOLDERS = 4
READS = 10


class Files:
    """Files under one folder of any store that Hadoop knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._text = spark._jvm.org.apache.commons.io.IOUtils

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def listed(self, name: str) -> list[tuple[str, float]]:
        """Names in a folder and the seconds since they last changed; none if it is not there."""
        try:
            found = self._fs.listStatus(self._path(name))
        except Py4JJavaError as error:
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return []
            raise
        now = time.time()
        return [(f.getPath().getName(), now - f.getModificationTime() / 1000) for f in found]

    def read(self, name: str) -> str | None:
        try:
            stream = self._fs.open(self._path(name))
        except Py4JJavaError as error:
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return None
            raise
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write a file so that it appears whole or not at all."""
        folder, _, last = name.rpartition("/")
        hidden = f"{folder}/.{last}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(hidden), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self._fs.rename(self._path(hidden), self._path(name)):
            self._fs.delete(self._path(hidden), False)
            raise OSError(f"could not write {self.root}/{name}")

    def claim(self, name: str) -> bool:
        """Create an empty file; False if it is there already."""
        return self._fs.createNewFile(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def bytes_of(self, name: str) -> int:
        return self._fs.getContentSummary(self._path(name)).getLength()

    def count(self, name: str = "") -> int:
        return self._fs.getContentSummary(self._path(name)).getFileCount()


@dataclass
class State:
    """Live folders (with their dates at the end), the batches of every run, and the entries in the
    log that this state contains."""

    live: dict[str, None] = field(default_factory=dict)
    batches: dict[str, set[int]] = field(default_factory=dict)
    upto: dict[str, int] = field(default_factory=dict)
    entries: list[str] = field(default_factory=list)

    def committed(self, run: str, batch_id: int) -> bool:
        return batch_id <= self.upto.get(run, -1) or batch_id in self.batches.get(run, ())

    def add(self, entry: dict) -> None:
        removes = entry.get("removes", [])
        # Of two merges of one folder only the first counts, so no row is read twice.
        if all(folder in self.live for folder in removes):
            for folder in removes:
                del self.live[folder]
            self.live.update(dict.fromkeys(entry.get("adds", [])))
        if "run" in entry:
            self.batches.setdefault(entry["run"], set()).add(entry["batch_id"])

    def known(self) -> tuple[dict[str, int], dict[str, set[int]]]:
        """All stored batches, in a form that can be compared."""
        upto = {run: n for run, n in self.upto.items() if n >= 0}
        return upto, {run: n for run, n in self.batches.items() if n}

    def advance(self) -> None:
        """Keep the batches of a run without a gap as one number."""
        for run, numbers in self.batches.items():
            upto = self.upto.get(run, -1)
            while upto + 1 in numbers:
                upto += 1
            self.upto[run], self.batches[run] = upto, {n for n in numbers if n > upto}


def date_of(folder: str) -> str:
    return folder.rpartition("date=")[2]


class StoredTable:
    """The log of one table and what can be done to it. One instance belongs to one session."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def is_logged(self) -> bool:
        return self.files.exists(LOG)

    def state(self) -> State:
        """The table as of its last entry; entries that vanish meanwhile are in a newer snapshot."""
        for _ in range(READS):
            found = self._read_state()
            if found is not None:
                return found
        raise OSError(f"the log of {self.path} changes faster than it can be read")

    def _read_state(self) -> State | None:
        names = sorted(name for name, _ in self.files.listed(LOG) if name.endswith(".json"))
        snapshots = [n for n in names if n.startswith("snapshot-")]
        state, covered = State(), set()
        if snapshots:
            text = self.files.read(f"{LOG}/{snapshots[-1]}")
            if text is None:
                return None
            kept = json.loads(text)
            state = State(
                dict.fromkeys(kept["live"]),
                {run: set(n) for run, n in kept["batches"].items()},
                kept["upto"],
            )
            covered = set(kept["covered"])
        # Batches first: a merge only takes out what batches, or merges before it, have added.
        for name in [n for n in names if n.startswith("batch-")] + [n for n in names if n.startswith("merge-")]:
            if name in covered:
                state.entries.append(name)  # left over by a snapshot that did not come to its end
                continue
            text = self.files.read(f"{LOG}/{name}")
            if text is None:
                return None
            state.add(json.loads(text))
            state.entries.append(name)
        state.advance()
        return state

    def append(self, df: DataFrame, run: str, batch_id: int) -> bool:
        """Store one batch, which has a column ``date``; False if it is stored already.

        A write that fails leaves a folder that no reader sees; the next try has its own.
        """
        name = f"batch-{run}-{batch_id:012d}.json"
        if self.files.exists(f"{LOG}/{name}") or self.state().committed(run, batch_id):
            return False
        folder = f"run={run}/batch_id={batch_id}/try={uuid.uuid4().hex}"
        df.write.partitionBy("date").parquet(f"{self.path}/{folder}")
        dates = [d for d, _ in self.files.listed(folder) if d.startswith("date=")]
        entry = {"run": run, "batch_id": batch_id, "adds": [f"{folder}/{d}" for d in sorted(dates)]}
        self.files.write(f"{LOG}/{name}", json.dumps(entry))
        return True

    def batch_folders(self, run: str, batch_id: int) -> list[str]:
        """Live folders of one batch that is not merged yet."""
        prefix = f"run={run}/batch_id={batch_id}/"
        return [folder for folder in self.state().live if folder.startswith(prefix)]

    def folders(self, since: str | None = None, until: str | None = None) -> list[str]:
        """Live folders, of dates within bounds (both included) only; no date lies in no bounds."""
        live = self.state().live
        if since or until:
            live = [f for f in live if date_of(f)[:1].isdigit()]
        return [f for f in live if (not since or date_of(f) >= since) and (not until or date_of(f) <= until)]

    def read(self, schema, folders: Iterable[str]) -> DataFrame:
        """The rows of live folders as they are now: later entries do not change this DataFrame."""
        paths = [f"{self.path}/{folder}" for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def compact(
        self,
        target_bytes: int = TARGET_BYTES,
        least: int = LEAST_FOLDERS,
        combine: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Merge the small folders of every date; the number of folders taken out.

        ``combine`` may reduce the rows that are merged, to sums for instance.

        A stream may go on writing: its batches are neither lost nor doubled. One merge runs at a
        time; a second one is refused by an error. After a crash ``release`` lets the next one in.
        """
        if not self.files.claim(f"{LOG}/merging"):
            raise RuntimeError(f"{self.path} is being merged already (see release)")
        try:
            by_date: dict[str, list[str]] = {}
            for folder in self.state().live:
                by_date.setdefault(date_of(folder), []).append(folder)
            taken = 0
            for date, mine in sorted(by_date.items()):
                taken += self._merge(date, mine, target_bytes, least, combine)
            if taken:
                self.snapshot()
            return taken
        finally:
            self.release()

    def release(self) -> None:
        """Let the next merge in."""
        self.files.delete(f"{LOG}/merging")

    def _merge(self, date: str, folders: list[str], target_bytes: int, least: int, combine) -> int:
        sizes = {folder: self.files.bytes_of(folder) for folder in folders}
        small = [folder for folder in folders if sizes[folder] < target_bytes // 2]
        if len(small) < least:
            return 0
        parts = max(1, ceil(sum(sizes[f] for f in small) / target_bytes))
        merged = f"run=merged/batch_id=0/try={uuid.uuid4().hex}/date={date}"
        rows = self.spark.read.parquet(*[f"{self.path}/{folder}" for folder in small])
        rows = combine(rows) if combine else rows
        rows.coalesce(parts).write.parquet(f"{self.path}/{merged}")
        name = f"merge-{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        self.files.write(f"{LOG}/{name}", json.dumps({"adds": [merged], "removes": small}))
        return len(small)

    def snapshot(self) -> None:
        """Write the state as one entry, then drop the entries and the snapshots that it covers."""
        state = self.state()
        kept = {
            "live": list(state.live),
            "batches": {run: sorted(n) for run, n in state.batches.items()},
            "upto": state.upto,
            "covered": state.entries,
        }
        name = f"snapshot-{time.time_ns():020d}.json"
        self.files.write(f"{LOG}/{name}", json.dumps(kept))
        old = [n for n, _ in self.files.listed(LOG) if n.startswith("snapshot-") and n < name]
        for entry in [*state.entries, *old]:
            self.files.delete(f"{LOG}/{entry}")

    def vacuum(self, older_than: float = 7 * 86400) -> int:
        """Delete folders that no entry lists and that have not changed for so many seconds.

        These are merged batches and failed writes. Reads that began before may still need them, and
        writes that go on have not changed for as long as their tasks run, hence the age. Returns
        the number of folders deleted.
        """
        live, gone = self.state().live, 0
        tries: dict[str, set[str]] = {}
        for folder in live:
            tries.setdefault(folder.rpartition("/")[0], set()).add(folder.rpartition("/")[2])
        for run, _ in self.files.listed(""):
            if not run.startswith("run="):
                continue
            for batch, _ in self.files.listed(run):
                for one, age in self.files.listed(f"{run}/{batch}"):
                    folder = f"{run}/{batch}/{one}"
                    if age <= older_than:
                        continue
                    if folder not in tries:
                        self.files.delete(folder)
                        gone += 1
                        continue
                    for date, _ in self.files.listed(folder):
                        if date.startswith("date=") and date not in tries[folder]:
                            self.files.delete(f"{folder}/{date}")
                            gone += 1
                if not self.files.listed(f"{run}/{batch}"):
                    self.files.delete(f"{run}/{batch}")
        return gone
