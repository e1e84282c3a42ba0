"""A change log as a data source of Spark's own (S1-S3, S6, T1, T4, T5; sink: K1, K5, X5).

``spark.read``, ``spark.readStream``, ``df.write`` and ``df.writeStream`` take ``format("change_log")``
after ``register(spark)``.  A log is a folder of Parquet files and one small text per
committed epoch that names the epoch's files; what no epoch names isn't there.

*Source.*  The offset of a stream is the sequence read last, kept by Spark's checkpoint:
a restarted query goes on behind it, ``start`` seeks anywhere in a new one.  A
micro-batch is a range of sequences, so rows that share one are never parted; with
``rows_per_batch`` it holds about as many rows (an ``availableNow`` run is one micro-batch,
so leave that out there).  Its tasks read parts of the range from
the files that reach into it.  A log is written in order of sequence: rows that come
behind a reader's cursor are not seen by it.

*Sink.*  Tasks write files under fresh names; commit publishes them by the epoch's text,
named after the writer and the batch id.  A writer that fails before commit leaves
nothing visible, and an epoch that is written again adds nothing.

Paths are local or in any store that ``pyarrow.fs`` opens; Spark's own readers are not
used, since they don't take part in a Python source.

Options: ``path``; source: ``start`` (cursor, default before the first), ``end`` (batch reads),
``rows_per_batch`` (default: all there is), ``rows_per_task``; sink: ``writer`` (names the
stream, default ``main``), ``epoch`` (names a batch write, so that it can be repeated),
``rows_per_mark`` (how finely readers can limit their batches).
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT, SEQUENCE, START = "change_log", "sequence", -1
#: An epoch's text holds the sequence after every ``rows_per_mark`` rows of a file; a file holds at most about ``FILE_ROWS``.
MARK, FILE_ROWS = 4096, 1 << 18
ROWS_PER_TASK = 250_000
#: Texts of epochs that a reader fetches at a time.
READERS = 16


def register(spark: SparkSession) -> None:
    """Make ``format("change_log")`` known to the session."""
    from tributary.session import ship_package
    ship_package(spark)
    spark.dataSource.register(ChangeLog)


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _epochs(path: str) -> list[str]:
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/epochs", allow_not_found=True))
    return sorted(f.base_name for f in found if not f.base_name.startswith("."))


def _read_epoch(path: str, name: str) -> dict:
    fs, root = _open(path)
    with fs.open_input_stream(f"{root}/epochs/{name}") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: name, rows, lowest sequence and marks of each."""

    files: tuple = ()


class _Writer:
    def __init__(self, schema: StructType, options):
        self.schema, self.path, self.writer = schema, options["path"], options.get("writer", "main")
        self.step = int(options.get("rows_per_mark", MARK))

    def write(self, iterator) -> Written:
        held, rows, files = [], 0, []
        for b in iterator:
            held.append(b)
            rows += len(b)
            if rows >= FILE_ROWS:
                files.append(self._file(held))
                held, rows = [], 0
        if rows:
            files.append(self._file(held))
        return Written(tuple(files))

    def _file(self, batches) -> dict:
        fs, root = _open(self.path)
        rows = pa.Table.from_batches(batches).cast(to_arrow_schema(self.schema)).sort_by(SEQUENCE)
        if rows[SEQUENCE].null_count:
            raise ValueError("a change without a sequence can't be written to a log")
        name, seq = f"{uuid.uuid4().hex}.parquet", rows[SEQUENCE].to_numpy()
        fs.create_dir(f"{root}/data", recursive=True)
        pq.write_table(rows, f"{root}/data/{name}", filesystem=fs, row_group_size=MARK * 8)
        marks = [int(x) for x in seq[self.step - 1::self.step]] + ([int(seq[-1])] if len(seq) % self.step else [])
        return {"name": name, "rows": len(seq), "low": int(seq[0]), "step": self.step, "marks": marks}

    def publish(self, messages, epoch: str) -> None:
        fs, root = _open(self.path)
        if fs.get_file_info(f"{root}/epochs/{epoch}").type == pafs.FileType.File:          # written before: what this attempt wrote is not needed
            self.discard(messages)
            return
        fs.create_dir(f"{root}/epochs", recursive=True)
        draft = f"{root}/epochs/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps({"schema": self.schema.json(), "files": [x for m in messages if m for x in m.files]}).encode())
        fs.move(draft, f"{root}/epochs/{epoch}")

    def discard(self, messages) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for x in m.files if m else ():
                fs.delete_file(f"{root}/data/{x['name']}")


class LogWriter(_Writer, DataSourceArrowWriter):
    """A batch write is one epoch, named by the option ``epoch``."""

    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.epoch = options.get("epoch", uuid.uuid4().hex)

    def commit(self, messages) -> None:
        self.publish(messages, f"{self.writer}-{self.epoch}")

    def abort(self, messages) -> None:
        self.discard(messages)


class LogStreamWriter(_Writer, DataSourceStreamArrowWriter):
    """A micro-batch is one epoch, named by its batch id."""

    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, f"{self.writer}-{batchId:012d}")

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


@dataclass
class Range(InputPartition):
    """Rows with ``after < sequence <= upto`` of some files."""

    after: int
    upto: int
    files: tuple


class _Files:
    """The committed files of a log; texts of epochs are read once, their marks ordered once per new epoch."""

    def __init__(self, path: str):
        self.path, self.known, self.files = path, set(), []
        self._order()

    def refresh(self) -> "_Files":
        new = [n for n in _epochs(self.path) if n not in self.known]
        if new:
            with ThreadPoolExecutor(READERS) as pool:
                for name, epoch in zip(new, pool.map(lambda n: _read_epoch(self.path, n), new)):
                    self.files += epoch["files"]
                    self.known.add(name)
            self._order()
        return self

    def _order(self) -> None:
        """Sequences at which a range may end, the rows up to each of them, and where the files begin and end."""
        found = [(m, min(f["step"], f["rows"] - i * f["step"])) for f in self.files for i, m in enumerate(f["marks"])]
        marks = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.ends, self.rows = marks[:, 0], marks[:, 1].cumsum()
        self.names = [f["name"] for f in self.files]
        self.low = np.array([f["low"] for f in self.files], np.int64)
        self.high = np.array([f["marks"][-1] for f in self.files], np.int64)

    def _behind(self, after: int) -> tuple[int, int]:
        """The first mark behind ``after``, and the rows up to ``after``'s last one."""
        i = int(np.searchsorted(self.ends, after, "right"))
        return i, int(self.rows[i - 1]) if i else 0

    def upto(self, after: int, rows: int | None) -> int:
        """The last sequence of a batch of about ``rows`` behind ``after`` (``after`` itself if there is none)."""
        i, before = self._behind(after)
        if i == len(self.ends):
            return after
        if rows is None:
            return int(self.ends[-1])
        return int(self.ends[min(int(np.searchsorted(self.rows, before + rows, "right")), len(self.ends) - 1)])

    def ranges(self, after: int, upto: int, rows: int) -> list[Range]:
        i, before = self._behind(after)
        here = slice(i, int(np.searchsorted(self.ends, upto, "right")))
        cuts = [int(m) for m in self.ends[here][np.flatnonzero(np.diff((self.rows[here] - before) // rows))]]
        edges, out = sorted({after, upto, *cuts}), []
        for lo, hi in zip(edges, edges[1:]):
            files = tuple(self.names[k] for k in np.flatnonzero((self.low <= hi) & (self.high > lo)))
            if files:
                out.append(Range(lo, hi, files))
        return out


class _Reader:
    def __init__(self, schema: StructType, options):
        self.schema, self.path = schema, options["path"]
        self.start, self.rows = int(options.get("start", START)), int(options.get("rows_per_task", ROWS_PER_TASK))
        self.files = _Files(self.path)

    def read(self, partition: Range | None):
        if partition is None:                    # how Spark asks where there are no partitions
            return
        fs, root = _open(self.path)
        kinds = to_arrow_schema(self.schema)
        data = pads.dataset([f"{root}/data/{f}" for f in partition.files], format="parquet", filesystem=fs)
        here = (pc.field(SEQUENCE) > partition.after) & (pc.field(SEQUENCE) <= partition.upto)
        for b in data.to_batches(columns=kinds.names, filter=here):
            if len(b):
                yield from pa.Table.from_batches([b]).cast(kinds).to_batches()


class LogReader(_Reader, DataSourceReader):
    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.end = int(options["end"]) if "end" in options else None

    def partitions(self):
        self.files.refresh()
        upto = self.files.upto(self.start, None) if self.end is None else self.end
        return self.files.ranges(self.start, upto, self.rows)


class LogStreamReader(_Reader, DataSourceStreamReader):
    """Offsets are ``{"sequence": last one read}``."""

    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.limit = int(options["rows_per_batch"]) if "rows_per_batch" in options else None
        self.at = None

    def initialOffset(self) -> dict:
        return {SEQUENCE: self.start}

    def latestOffset(self) -> dict:
        at = self.start if self.at is None else self.at
        self.at = self.files.refresh().upto(at, self.limit)
        return {SEQUENCE: self.at}

    def partitions(self, start: dict, end: dict):
        # a restarted query plans its last batch first, which tells where it stands
        self.at = max(end[SEQUENCE], START if self.at is None else self.at)
        return self.files.refresh().ranges(start[SEQUENCE], end[SEQUENCE], self.rows)


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        names = _epochs(self.options["path"])
        if not names:
            raise ValueError(f"no epoch in {self.options['path']}: give the schema of an empty log")
        return StructType.fromJson(json.loads(_read_epoch(self.options["path"], names[0])["schema"]))

    def reader(self, schema):
        return LogReader(schema, self.options)

    def streamReader(self, schema):
        return LogStreamReader(schema, self.options)

    def writer(self, schema, overwrite):
        return LogWriter(schema, self.options)

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(schema, self.options)
