"""A table service as a Python data source, with a folder standing in for the remote side.

Each write has a folder of its own, where tasks put their rows in requests of bounded size, a file each,
and counts once its marker is there: one small file that names the tasks that won. So two writers never
touch each other's files, `abort` removes the write's own folder alone, and the same rows sent again are
changes of their own. Readers get rows in the order of writes (`write_no`) and within one (`row_no`). The folder may be
any path that pyarrow's file systems know (local, `file:`, `hdfs:`, `s3:`).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

MOST_ROWS, TRIES, WAIT = 1000, 3, 0.2  # of a request; seconds doubled after each try
ROWS_A_TASK = 50_000  # that a reader takes, about


@dataclass
class Sent(WriterCommitMessage):
    """What a task sent: its place, its attempt, how many files, how many rows."""

    part: int = 0
    attempt: int = 0
    files: int = 0
    rows: int = 0


class Folder:
    def __init__(self, path: str):
        self.fs, self.path = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return f.read()

    def write(self, name: str, body: bytes) -> None:
        """The whole file or none of it, tried again where the service fails."""
        sub, _, base = name.rpartition("/")
        for i in range(TRIES):
            try:
                self.fs.create_dir(f"{self.path}/{sub}", recursive=True)
                hidden = f"{self.path}/{sub}/.{base}.{uuid.uuid4().hex}"
                with self.fs.open_output_stream(hidden) as f:
                    f.write(body)
                self.fs.move(hidden, f"{self.path}/{name}")
                return
            except OSError:
                if i + 1 == TRIES:
                    raise
                time.sleep(WAIT * 2**i)

    def markers(self) -> list[str]:
        """Names of the writes that count, `time-id`, in order."""
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        return sorted(x.base_name for x in found if x.is_file and not x.base_name.startswith("."))

    def has(self, write: str) -> bool:
        return any(m.partition("-")[2] == write for m in self.markers())

    def remove(self, folder: str) -> None:
        if self.fs.get_file_info(f"{self.path}/writes/{folder}").type == fs.FileType.Directory:
            self.fs.delete_dir(f"{self.path}/writes/{folder}")


class TableWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool = False, batch_by: tuple[str, ...] = (), most_rows: int = MOST_ROWS, write: str | None = None):
        self.path, self.overwrite, self.batch_by, self.most_rows = path, overwrite, batch_by, most_rows
        self.columns = [c for c in columns if c not in batch_by]
        self.folder = uuid.uuid4().hex
        self.id = re.sub(r"[^A-Za-z0-9_.]", "_", write) if write else self.folder

    def write(self, rows):
        folder, context = Folder(self.path), TaskContext.get()
        sent = Sent(context.partitionId(), context.taskAttemptId()) if context else Sent()
        batch, lines = None, []

        def send() -> None:
            folder.write(f"writes/{self.folder}/{sent.part}-{sent.attempt}-{sent.files}.jsonl", "\n".join(lines).encode())
            sent.files += 1
            lines.clear()

        for row in rows:
            now = tuple(row[c] for c in self.batch_by)
            if lines and (now != batch or len(lines) >= self.most_rows):
                send()
            batch = now
            lines.append(json.dumps({c: row[c] for c in self.columns}, sort_keys=True, default=str))
            sent.rows += 1
        if lines:
            send()
        return sent

    def commit(self, messages):
        folder = Folder(self.path)
        if folder.has(self.id):  # a write of this name is there already
            folder.remove(self.folder)
            return
        tasks = sorted((m.part, m.attempt, m.files, m.rows) for m in messages if m)
        folder.write(f"commits/{time.time_ns():020d}-{self.id}", json.dumps({"folder": self.folder, "overwrite": self.overwrite, "tasks": tasks}).encode())

    def abort(self, messages):
        folder = Folder(self.path)
        if not any(json.loads(folder.read(f"commits/{m}"))["folder"] == self.folder for m in folder.markers() if m.partition("-")[2] == self.id):
            folder.remove(self.folder)


class TableReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self):
        """Runs of files of about ROWS_A_TASK rows; a marker has an entry a task, so what the driver lists doesn't grow with requests."""
        folder, runs, rows = Folder(self.path), [[]], 0
        entries = [json.loads(folder.read(f"commits/{m}")) for m in folder.markers()]
        first = max([n for n, e in enumerate(entries) if e["overwrite"]], default=0)
        for n, entry in enumerate(entries[first:], first):
            for part, attempt, files, of_task in entry["tasks"]:
                at, step = 0, max(1, files * ROWS_A_TASK // max(1, of_task))
                while at < files:
                    end = min(files, at + step)
                    if rows >= ROWS_A_TASK:
                        runs.append([])
                        rows = 0
                    runs[-1].append((n, f"writes/{entry['folder']}/{part}-{attempt}", part, at, end))
                    rows += of_task * (end - at) // files
                    at = end
        return [InputPartition(r) for r in runs]

    def read(self, partition):
        folder = Folder(self.path)
        for n, name, part, at, end in partition.value:
            for file in range(at, end):
                for i, line in enumerate(folder.read(f"{name}-{file}.jsonl").decode().split("\n")):
                    row = json.loads(line) | {"write_no": n, "row_no": (part << 40) | (file << 16) | i}
                    yield tuple(row.get(c) for c in self.columns)


class TableService(DataSource):
    """spark.read / df.write .format("table_service").option("path", folder).

    Writes also take `batch_by` (columns), `most_rows` of a request (65,536 at most) and `write_id`: a write sent again under one name
    counts once. Rows read have the columns of the schema asked for; write_no and row_no, in which they sort as they were sent, are always to be had.
    """

    @classmethod
    def name(cls) -> str:
        return "table_service"

    def schema(self) -> str:
        return "doc_id bigint, op string, content_hash string, write_no bigint, row_no bigint"

    def writer(self, schema, overwrite):
        by = tuple(c for c in self.options.get("batch_by", "").split(",") if c)
        return TableWriter(self.options["path"], schema.names, overwrite, by, min(1 << 16, int(self.options.get("most_rows", MOST_ROWS))), self.options.get("write_id"))

    def reader(self, schema):
        return TableReader(self.options["path"], schema.names)
