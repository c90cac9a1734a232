"""Landing by rows or by time: a stream source that decides itself when a batch is due.

Events wait in a folder as parquet files of text. A batch is admitted once enough rows wait,
or the first of them has waited long enough, or no more are to come; until then the offset
stays where it is and Spark starts no batch. Row counts come from file footers, so nothing
is read to decide. What a batch consists of is written down before its offset is given
out, in a log of one small file for each batch; the offset is the number of the last one. So
a batch that runs again has the same files, and a restart finds files admitted before it.

Where more waits than one batch needs, several are admitted at once, each with its own entry
and number: Spark lands them together, as ``batch_id`` tells them apart. So a backlog takes
as many jobs as there are groups of ``MOST_BATCHES``, not one for each batch.

Each batch is a partition, read by a task as Arrow batches. The folder and the
log must be reachable for the driver and all executors under the same address.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from stayledger.constants import LANDING_MAX_SECONDS, LANDING_MIN_ROWS
from stayledger.sources.events import to_events

# The source runs in processes that need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "landing_rule"
EVENT = "value string, batch_id int"
# Batches that may be admitted at once.
MOST_BATCHES = 200
# Footers that are read at a time.
FOOTERS = 16


def opened(address: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an address, with or without a scheme."""
    if ":" in address.split("/", 1)[0]:
        return pafs.FileSystem.from_uri(address)
    return pafs.LocalFileSystem(), address


def listed(files: pafs.FileSystem, folder: str) -> list[str]:
    """Paths of the visible files in a folder and below, in order; none where there is no folder."""
    found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True))
    visible = [f.path for f in found if f.is_file]
    return sorted(p for p in visible if not any(n.startswith(("_", ".")) for n in p[len(folder) :].split("/")))


class AdmissionLog:
    """What each batch consists of, in numbered files."""

    def __init__(self, address: str):
        self.files, self.folder = opened(address)
        self.files.create_dir(self.folder, recursive=True)

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def last(self) -> int:
        found = listed(self.files, self.folder)
        return int(found[-1].rsplit("/", 1)[1].split(".")[0]) if found else 0

    def read(self, number: int) -> list[str]:
        with self.files.open_input_stream(self._path(number)) as entry:
            return json.loads(entry.read())

    def write(self, number: int, paths: list[str]) -> None:
        hidden = f"{self.folder}/.{number:012d}"
        with self.files.open_output_stream(hidden) as entry:
            entry.write(json.dumps(paths).encode())
        self.files.move(hidden, self._path(number))


@dataclass
class EventFiles(InputPartition):
    paths: list[str]
    batch_id: int


class LandingReader(DataSourceStreamReader):
    """The source's reader. ``clock`` tells seconds; tests give one of their own."""

    def __init__(self, options: dict, clock: Callable[[], float] = time.time):
        self.address = options["path"]
        self.min_rows = int(options.get("minrows", LANDING_MIN_ROWS))
        self.max_seconds = float(options.get("maxseconds", LANDING_MAX_SECONDS))
        self.ending = str(options.get("ending", "false")).lower() == "true"
        self.log_address = options["log"]
        self.clock = clock
        self.state = None

    def _restore(self) -> None:
        """What was admitted before, once for a run."""
        log = AdmissionLog(self.log_address)
        last = log.last()
        admitted = {p for n in range(1, last + 1) for p in log.read(n)}
        self.state, self.last, self.admitted = log, last, admitted
        # Rows of files that wait, in the order they were seen; since when the first one waits.
        self.waiting: dict[str, int] = {}
        self.since: float | None = None

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        if self.state is None:
            self._restore()
        files, folder = opened(self.address)
        new = [p for p in listed(files, folder) if p not in self.admitted and p not in self.waiting]

        def rows(path: str) -> int:
            with files.open_input_file(path) as file:
                return pq.read_metadata(file).num_rows

        with ThreadPoolExecutor(FOOTERS) as pool:
            self.waiting.update(zip(new, pool.map(rows, new), strict=True))
        if not self.waiting:
            self.since = None
            return {"batch": self.last}
        now = self.clock()
        self.since = now if self.since is None else self.since
        left, late = sum(self.waiting.values()), now - self.since >= self.max_seconds
        for _ in range(MOST_BATCHES):
            if not self.waiting or not (left >= self.min_rows or self.ending or late):
                break
            left -= self._admit()
            # The clock of those left runs from here.
            self.since, late = now if self.waiting else None, False
        return {"batch": self.last}

    def _admit(self) -> int:
        """Admit files in their order until there are enough rows, or all, and say how many rows."""
        chosen, rows = [], 0
        for path, n in self.waiting.items():
            if rows >= self.min_rows:
                break
            chosen.append(path)
            rows += n
        self.state.write(self.last + 1, chosen)
        self.last += 1
        self.admitted.update(chosen)
        for path in chosen:
            del self.waiting[path]
        return rows

    def partitions(self, start: dict, end: dict) -> list[EventFiles]:
        log = AdmissionLog(self.log_address)
        return [EventFiles(log.read(n), n - 1) for n in range(start["batch"] + 1, end["batch"] + 1)]

    def read(self, partition: EventFiles) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.address)
        for path in partition.paths:
            with files.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(columns=["value"]):
                    number = pa.array([partition.batch_id] * batch.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), number], names=["value", "batch_id"])


class LandingRule(DataSource):
    """Options: ``path``, ``log``, ``minRows``, ``maxSeconds``, and ``ending`` if no more rows come."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return EVENT

    def streamReader(self, schema: StructType) -> LandingReader:
        return LandingReader({k.lower(): v for k, v in dict(self.options).items()})


def queue_events(df: DataFrame, folder: str, max_rows: int) -> str:
    """Add the rows as JSON events to a folder of waiting events, at most ``max_rows`` a file."""
    to_events(df).write.mode("append").option("maxRecordsPerFile", max_rows).parquet(folder)
    return folder


def read_waiting(
    spark: SparkSession,
    folder: str,
    log: str,
    min_rows: int = LANDING_MIN_ROWS,
    max_seconds: float = LANDING_MAX_SECONDS,
    ending: bool = False,
) -> DataFrame:
    """Stream of event text in batches of at least ``min_rows``, or what waits after ``max_seconds``."""
    spark.dataSource.register(LandingRule)
    options = {"path": folder, "log": log, "minRows": min_rows, "maxSeconds": max_seconds, "ending": str(ending).lower()}
    return spark.readStream.format(FORMAT).options(**options).load()
