"""Files that Spark's own writers do not make: flat token streams, and one text file a record.

Both are Python data sources.  Tasks write temporary files on the file system that driver and
executors share, and the driver's commit puts them in place; a lost executor's half files are
never seen under a final name.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from quern.session import ship

#: Token ids are stored as unsigned 16-bit little-endian numbers.
TOKEN, TOKEN_LIMIT = "<u2", 1 << 16
META = "meta.json"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int, int]]  # temporary name, final name, order, length


def _checked(options: dict, name: str) -> str:
    if not options.get(name):
        raise ValueError(f"the option {name} is needed")
    return options[name]


def _forget(folder: Path, messages: list[Written | None]) -> None:
    for message in messages:
        for temporary, *_ in message.files if message else []:
            (folder / temporary).unlink(missing_ok=True)


class TokenWriter(DataSourceArrowWriter):
    """Rows are (split, window, ids), sorted inside a partition; partitions follow each other.

    Every split ends as one folder of ``part-NNNNN.bin`` whose concatenation, in the order of
    their names, is the split's stream.  ``meta.json`` names the parts and their lengths.
    """

    def __init__(self, folder: str):
        self.folder = Path(folder)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        self.folder.mkdir(parents=True, exist_ok=True)
        mark, files = uuid.uuid4().hex, {}
        try:
            for batch in batches:
                for split, window, ids in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("split", "window", "ids")), strict=True):
                    tokens = np.asarray(ids.values if ids.is_valid else [], np.int64)
                    if len(tokens) and (tokens.min() < 0 or tokens.max() >= TOKEN_LIMIT):
                        raise ValueError("a token id does not fit into 16 bits")
                    name = split.as_py()
                    if name not in files:
                        temporary = f".{mark}-{name}.tmp"
                        files[name] = [temporary, name, window.as_py(), 0, open(self.folder / temporary, "wb")]
                    files[name][4].write(tokens.astype(TOKEN).tobytes())
                    files[name][3] += len(tokens)
        finally:
            for entry in files.values():
                entry[4].close()
        return Written([tuple(entry[:4]) for entry in files.values()])

    def commit(self, messages: list[Written | None]) -> None:
        meta: dict[str, dict] = {}
        for temporary, split, order, length in sorted((f for m in messages if m for f in m.files), key=lambda f: (f[1], f[2])):
            entry = meta.setdefault(split, {"n_tokens": 0, "parts": []})
            name = f"{split}/part-{len(entry['parts']):05d}.bin"
            (self.folder / split).mkdir(exist_ok=True)
            os.replace(self.folder / temporary, self.folder / name)
            entry["parts"].append([name, length])
            entry["n_tokens"] += length
        (self.folder / META).write_text(json.dumps({"dtype": "uint16", "splits": meta}, indent=2) + "\n")

    def abort(self, messages: list[Written | None]) -> None:
        _forget(self.folder, messages)


@dataclass
class Stretch(InputPartition):
    split: str
    first: int
    count: int


class TokenReader(DataSourceReader):
    """Windows of ``length`` ids from each split, every ``stride`` ids (default: the length)."""

    def __init__(self, folder: str, options: dict):
        self.folder = Path(folder)
        self.length = int(_checked(options, "length"))
        self.stride = int(options.get("stride", self.length))
        self.tasks = int(options.get("tasks", 64))
        if self.length < 1 or self.stride < 1:
            raise ValueError("length and stride start at one")
        self.splits = json.loads((self.folder / META).read_text())["splits"]

    def partitions(self) -> list[Stretch]:
        out = []
        for split, entry in self.splits.items():
            windows = max(0, (entry["n_tokens"] - self.length) // self.stride + 1)
            share = max(1, -(-windows // self.tasks))
            out += [Stretch(split, w, min(share, windows - w)) for w in range(0, windows, share)]
        return out or [Stretch("", 0, 0)]

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        for w in range(part.first, part.first + part.count):
            ids = self._ids(part.split, w * self.stride)
            yield pa.RecordBatch.from_arrays([pa.array([part.split]), pa.array([w], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], names=["split", "window", "ids"])

    def _ids(self, split: str, at: int) -> np.ndarray:
        """``length`` ids from place ``at``, across the borders of parts; only they are read."""
        found, begin, end = [], 0, at + self.length
        for name, length in self.splits[split]["parts"]:
            low, high = max(at, begin), min(end, begin + length)
            if low < high:
                found.append(np.fromfile(self.folder / name, TOKEN, high - low, offset=2 * (low - begin)))
            begin += length
        return np.concatenate(found)


class TokenBin(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_bin"

    def schema(self) -> str:
        return "split string, window long, ids array<int>"

    def reader(self, schema: StructType) -> TokenReader:
        return TokenReader(_checked(self.options, "path"), self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TokenWriter:
        return TokenWriter(_checked(self.options, "path"))


class MirrorWriter(DataSourceArrowWriter):
    """Rows are (path, text): each becomes ``<path>.txt`` below the folder, in place at once."""

    def __init__(self, folder: str):
        self.folder = Path(folder)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        self.folder.mkdir(parents=True, exist_ok=True)
        count, root = 0, self.folder.resolve()
        for batch in batches:
            paths, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("path", "text"))
            for path, text in zip(paths, texts, strict=True):
                target = (root / f"{path}.txt").resolve()
                if path is None or root not in target.parents:
                    raise ValueError(f"{path!r} leads out of the folder")
                target.parent.mkdir(parents=True, exist_ok=True)
                temporary = target.with_name(f".{uuid.uuid4().hex}.tmp")
                try:
                    temporary.write_text(text or "", encoding="utf-8")
                    os.replace(temporary, target)
                finally:
                    temporary.unlink(missing_ok=True)
                count += 1
        return Written([("", "", 0, count)])

    def commit(self, messages: list[Written | None]) -> None:
        """Files are already in place: a repeated task wrote the same text again."""


class MirroredText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mirrored_text"

    def schema(self) -> str:
        return "path string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> MirrorWriter:
        return MirrorWriter(_checked(self.options, "path"))


def register(spark: SparkSession) -> None:
    ship(spark)
    for source in (TokenBin, MirroredText):
        spark.dataSource.register(source)


def write_token_bin(windows: DataFrame, path: str, parts: int = 64) -> None:
    """The streams of ``windows`` (split, window, ids) as flat files below ``path``.

    Range partitions over (split, window) follow each other, so no task holds a whole split.
    ``path`` has to be one that driver and executors share.
    """
    register(windows.sparkSession)
    ordered = windows.select("split", "window", "ids").repartitionByRange(parts, "split", "window").sortWithinPartitions("split", "window")
    ordered.write.format("token_bin").option("path", path).mode("append").save()


def read_token_bin(spark: SparkSession, path: str, length: int, stride: int | None = None) -> DataFrame:
    register(spark)
    return spark.read.format("token_bin").option("path", path).option("length", length).option("stride", stride or length).load()


def training_windows(spark: SparkSession, path: str, length: int) -> DataFrame:
    """split, window, x, y: inputs and the same ids shifted by one."""
    rows = read_token_bin(spark, path, length + 1, length)
    return rows.select("split", "window", F.slice("ids", 1, length).alias("x"), F.slice("ids", 2, length).alias("y"))


def write_mirror(records: DataFrame, path: str, name: str = "source") -> None:
    """One UTF-8 file a record, at its own relative path with ``.txt`` appended."""
    register(records.sparkSession)
    records.select(F.col(name).alias("path"), F.col("text")).write.format("mirrored_text").option("path", path).mode("append").save()
