"""A stream of the files in a folder, whatever their names, with its own offsets.

Spark's file source passes over names that begin with ``_`` or ``.``; shards may be called so. This source lists
the folder itself. Names that are new go, up to ``freq`` at a time, into numbered entries of a log beside the stream's
checkpoint, and the number of the last entry is the offset. An entry never changes once it is written, so a
batch that Spark repeats has the same files, and so does the wave that is named after an entry.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from shardweave.sources.files import open_fs

FORMAT = "shardweave_listing"
LISTED = "entry BIGINT, path STRING, bytes BIGINT"


class Entry(InputPartition):
    """One entry of the log."""

    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


def is_data(name: str) -> bool:
    """Checksums and the success marks of Spark's writers are no data; all else is."""
    return not name.startswith("_SUCCESS") and not name.endswith(".crc")


class ListingReader(DataSourceStreamReader):
    """Offsets ``{"entry": n}``: all entries up to n have been listed.

    The driver sees names and sizes, never contents: a line per shard file.
    """

    def __init__(self, options: dict):
        self.folder = options["path"].rstrip("/")
        self.log = options["log"].rstrip("/")
        self.freq = int(options.get("freq", "1000"))

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        numbers = self._numbers()
        seen = {path for number in numbers for _, path, _ in self.read(Entry(number))}
        fs, inner = open_fs(self.folder)
        new = []
        for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
            path = f"{self.folder}/{info.base_name}"
            if info.type == pafs.FileType.File and is_data(info.base_name) and path not in seen:
                new.append((path, info.size))
        new.sort()
        last = max(numbers, default=0)
        for start in range(0, len(new), self.freq):
            last += 1
            self._write(last, new[start : start + self.freq])
        return {"entry": last}

    def partitions(self, start: dict, end: dict) -> list[Entry]:
        return [Entry(number) for number in range(start["entry"] + 1, end["entry"] + 1)]

    def read(self, partition: Entry) -> Iterator[tuple]:
        fs, log = open_fs(self.log)
        with fs.open_input_stream(f"{log}/{partition.number:08d}.jsonl") as stream:
            for line in stream.read().splitlines():
                path, size = json.loads(line)
                yield partition.number, path, size

    def commit(self, end: dict) -> None:
        """The log stays: it is what tells new names from old ones."""

    def _numbers(self) -> list[int]:
        fs, log = open_fs(self.log)
        found = fs.get_file_info(pafs.FileSelector(log, allow_not_found=True))
        return sorted(int(info.base_name[:-6]) for info in found if re.fullmatch(r"\d{8,}\.jsonl", info.base_name))

    def _write(self, number: int, files: list[tuple[str, int]]) -> None:
        fs, log = open_fs(self.log)
        fs.create_dir(log, recursive=True)
        partial = f"{log}/{uuid.uuid4().hex}.partial"
        with fs.open_output_stream(partial) as out:
            out.write("".join(json.dumps(entry) + "\n" for entry in files).encode())
        fs.move(partial, f"{log}/{number:08d}.jsonl")


class ListingSource(DataSource):
    """``spark.readStream.format("shardweave_listing")``; options ``path``, ``log`` and ``freq``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTED

    def streamReader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))
