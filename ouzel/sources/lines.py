"""A streaming source of text lines over a growing folder.

``spark.dataSource.register(LineSource)``, then ``readStream.format("ouzel_lines")``.
Files may be added and may grow; an offset says how many bytes of each file are
done, always at a line's end, so a line that is still being written waits for the
rest of it. A batch is cut into pieces of at most ``piece`` bytes, which tasks read on
their own, and can be read again exactly as it was: no port, nothing is lost with a
restart. Rows: ``value``, the ``file``'s name, where the piece starts (``block``) and where
the line starts (``place``), in bytes.

Files are opened with pyarrow's file systems (file:, hdfs:, object stores). Names that
start with ``.`` or ``_`` are not read. An offset holds an entry for each file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need no installed package

LINE = "value string, file string, block long, place long"
LINES = pa.schema([("value", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("place", pa.int64())])
PIECE = 8 << 20
TAIL = 1 << 16


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


class Piece(InputPartition):
    def __init__(self, name: str, first: int, start: int, end: int, last: int):
        """Lines that start in start .. end; the batch's part of the file is first .. last."""
        self.name, self.first, self.start, self.end, self.last = name, first, start, end, last


class LineReader(DataSourceStreamReader):
    def __init__(self, folder: str, piece: int):
        self.folder, self.piece, self.done = folder, piece, {}

    def initialOffset(self) -> dict:
        return {}

    def _whole(self, fs: pafs.FileSystem, path: str, name: str, size: int) -> int:
        """The end of the file's last whole line."""
        known, end = self.done.get(name, 0), size
        with fs.open_input_file(path) as f:
            while end > known:
                at = max(known, end - TAIL)
                cut = f.read_at(end - at, at).rfind(b"\n")
                if cut >= 0:
                    return at + cut + 1
                end = at
        return known

    def latestOffset(self) -> dict:
        fs, root = open_folder(self.folder)
        for f in fs.get_file_info(pafs.FileSelector(root)):
            if f.is_file and f.base_name[:1] not in "._" and f.size > self.done.get(f.base_name, 0):
                end = self._whole(fs, f.path, f.base_name, f.size)
                if end:
                    self.done[f.base_name] = end
        return dict(sorted(self.done.items()))

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return [Piece(name, first, at, min(at + self.piece, last), last)
                for name, last in sorted(end.items()) for first in [start.get(name, 0)] for at in range(first, last, self.piece)]

    def read(self, p: Piece) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(self.folder)
        with fs.open_input_file(f"{root}/{p.name}") as f:
            # a line that starts before the piece is the piece's before
            at = p.start if p.start == p.first else self._next_line(f, p.start - 1, p.last)
            while at < p.end:
                raw = f.read_at(min(p.end, at + PIECE) - at, at)
                stop = at + len(raw)
                if not raw.endswith(b"\n"):
                    more = self._next_line(f, stop, p.last)
                    raw, stop = raw + f.read_at(more - stop, stop), more
                lines = raw[:-1].split(b"\n")
                places, place = [], at
                for x in lines:
                    places.append(place)
                    place += len(x) + 1
                for k in range(0, len(lines), 8192):
                    part = lines[k:k + 8192]
                    yield pa.record_batch([pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in part]),
                                           pa.array([p.name] * len(part)), pa.array([p.start] * len(part)),
                                           pa.array(places[k:k + 8192])], schema=LINES)
                at = stop

    @staticmethod
    def _next_line(f, at: int, last: int) -> int:
        """The first place after a line's end at ``at`` or later."""
        while at < last:
            cut = f.read_at(min(TAIL, last - at), at).find(b"\n")
            if cut >= 0:
                return at + cut + 1
            at += TAIL
        return last

    def commit(self, end: dict) -> None:
        pass


class LineSource(DataSource):
    """Options: ``path``, a folder; ``piece``, the most bytes of a piece."""

    @classmethod
    def name(cls) -> str:
        return "ouzel_lines"

    def schema(self) -> str:
        return LINE

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("piece", PIECE)))


def line_source(spark: SparkSession, folder: str, piece: int = PIECE) -> DataFrame:
    """The lines of the files in ``folder`` as a stream (columns of ``LINE``)."""
    spark.dataSource.register(LineSource)
    return spark.readStream.format("ouzel_lines").option("path", folder).option("piece", str(piece)).load()
