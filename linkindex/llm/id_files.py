"""Token ids in binary files: independent zstandard frames and a trailing seek table.

A file is a run of zstandard frames, each with its own content checksum and the ids of whole documents
only, then one skippable frame that ordinary zstandard readers pass over. It holds the seek table: of
every frame its compressed size, its size, its documents and the CRC-32 of its content; of every
document its id and number of ids; last a footer of fixed size, so a reader starts at the file's end.
Documents of other frames are never decompressed. A frame holds about ``FRAME_BYTES`` of ids (one
document at least), a file about ``FILE_BYTES``; a task writes as many files as it needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkindex.llm.common import quoted, shared_folder, staged
from linkindex.llm.tokens import id_encoder

FRAME_BYTES = 1 << 18
FILE_BYTES = 1 << 25
NO_ID = -(1 << 63)  #: stands for a null document id

_FRAME = np.dtype([("packed", "<u4"), ("bytes", "<u4"), ("docs", "<u4"), ("crc", "<u4")])
_DOC = np.dtype([("id", "<i8"), ("tokens", "<u4")])
_FOOTER = struct.Struct("<III4s")  # frames, documents, CRC-32 of the table, mark
_SKIPPABLE = struct.Struct("<II")
_MARK = b"IDZ1"
_SKIPPABLE_MAGIC = 0x184D2A50  # fixed by the zstandard format


class Writer:
    """Collects the documents of one file."""

    def __init__(self) -> None:
        self.body, self.size = [], 0
        self.frames: list[tuple] = []
        self.docs: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_size = 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, len(ids) // 4))
        self.open.append(ids)
        self.open_size += len(ids)
        if self.open_size >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            content = b"".join(self.open)
            packed = self.compressor.compress(content)
            self.frames.append((len(packed), len(content), len(self.open), zlib.crc32(content)))
            self.body.append(packed)
            self.size += len(packed)
            self.open, self.open_size = [], 0

    def finish(self) -> bytes:
        self.end_frame()
        table = np.array(self.frames, _FRAME).tobytes() + np.array(self.docs, _DOC).tobytes()
        footer = _FOOTER.pack(len(self.frames), len(self.docs), zlib.crc32(table), _MARK)
        head = _SKIPPABLE.pack(_SKIPPABLE_MAGIC, len(table) + len(footer))
        return b"".join([*self.body, head, table, footer])


def seek_table(tail: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frames and documents, from a file's bytes or from enough of its end."""
    frames, docs, crc, mark = _FOOTER.unpack(tail[-_FOOTER.size:])
    if mark != _MARK:
        raise ValueError("no seek table at the file's end")
    size = frames * _FRAME.itemsize + docs * _DOC.itemsize
    if size + _FOOTER.size > len(tail):
        raise EOFError(size + _FOOTER.size)
    table = tail[len(tail) - _FOOTER.size - size:len(tail) - _FOOTER.size]
    if zlib.crc32(table) != crc:
        raise ValueError("the seek table is damaged")
    return (np.frombuffer(table, _FRAME, frames),
            np.frombuffer(table, _DOC, docs, frames * _FRAME.itemsize))


def frame_documents(packed: bytes, frame: np.void, docs: np.ndarray) -> Iterator[tuple]:
    """``(doc_id, ids)`` of one frame, both checksums tested."""
    content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(frame["bytes"]))
    if zlib.crc32(content) != frame["crc"]:
        raise ValueError("a frame is damaged")
    at = 0
    for doc_id, tokens in docs.tolist():
        yield (None if doc_id == NO_ID else doc_id), content[at:at + 4 * tokens]
        at += 4 * tokens


def requested(uri: str, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """The ids of the requested documents of one file; reads its end and their frames only."""
    wanted = np.array(sorted(doc_ids), dtype=np.int64)
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        size = f.size()
        tail = f.read_at(min(size, 1 << 16), max(0, size - (1 << 16)))
        try:
            frames, docs = seek_table(tail)
        except EOFError as more:
            frames, docs = seek_table(f.read_at(more.args[0], size - more.args[0]))
        places = np.concatenate([[0], np.cumsum(frames["packed"], dtype=np.int64)])
        firsts = np.concatenate([[0], np.cumsum(frames["docs"], dtype=np.int64)])
        hits = np.flatnonzero(np.isin(docs["id"], wanted))
        found = {}
        for k in np.unique(np.searchsorted(firsts, hits, side="right") - 1):
            packed = f.read_at(int(frames[k]["packed"]), int(places[k]))
            for doc_id, ids in frame_documents(packed, frames[k], docs[firsts[k]:firsts[k + 1]]):
                if doc_id in wanted:
                    found[doc_id] = np.frombuffer(ids, "<u4")
        return found


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, folder: str, *,
              id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write every row's ids and ``end_id`` to files under ``folder``, in ascending order of the id.

    Returns the written files: ``part, file, name, n_docs, n_tokens``, in whose order the documents
    ascend. A null id comes first and equal ids go by their text; null and empty texts are ``end_id``
    alone; an empty table gives no file; other columns are not read. Files get their names when they
    are whole, so a task that is run again replaces its own files with equal ones.
    """
    uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = id_encoder(vocabulary), TaskContext.get().partitionId()
        encode, end = encoder.encode, encoder.packed([end_id])
        system, path = fs.FileSystem.from_uri(uri)
        files, writer = 0, Writer()

        def save() -> pa.RecordBatch:
            nonlocal files, writer
            name = f"ids-{part:06d}-{files:05d}.idz"
            system.create_dir(path, recursive=True)
            with system.open_output_stream(draft := f"{path}/.{name}.{uuid.uuid4().hex}") as f:
                f.write(writer.finish())
            system.move(draft, f"{path}/{name}")
            row = {"part": part, "file": files, "name": name, "n_docs": len(writer.docs),
                   "n_tokens": sum(n for _, n in writer.docs)}
            files, writer = files + 1, Writer()
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                writer.add(doc_id, encode(text) + end)
                if writer.size >= FILE_BYTES:
                    yield save()
        if writer.docs:
            yield save()

    ordered = (
        docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    return staged(ordered.mapInArrow(
        write, "part long, file long, name string, n_docs long, n_tokens long"
    ))


def read_ids(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, read from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                data = memoryview(content.as_buffer())
                frames, docs = seek_table(data)
                ids, crcs, at, first = [], [], 0, 0
                for frame in frames:
                    last = first + int(frame["docs"])
                    packed = data[at:at + int(frame["packed"])]
                    for doc_id, own in frame_documents(packed, frame, docs[first:last]):
                        ids.append(doc_id)
                        crcs.append(zlib.crc32(own))
                    at, first = at + int(frame["packed"]), last
                tokens = docs["tokens"].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.rsplit("/", 1)[-1]] * len(ids), pa.string()),
                     pa.array(ids, pa.int64()), pa.array(np.cumsum(tokens) - tokens),
                     pa.array(tokens), pa.array(crcs, pa.int64())],
                    ["name", "doc_id", "_within", "n_tokens", "ids_crc32"],
                )

    before = Window.orderBy("part", "file")  # one row per file
    bases = files.select("name", (F.sum("n_tokens").over(before) - F.col("n_tokens")).alias("_base"))
    if files.isEmpty():
        empty = "name string, doc_id long, _within long, n_tokens long, ids_crc32 long"
        documents = spark.createDataFrame([], empty)
    else:
        documents = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.idz").load(folder)
            .select("path", "content")
            .mapInArrow(read, "name string, doc_id long, _within long, n_tokens long, ids_crc32 long")
        )
    return documents.join(bases, "name").select(
        "doc_id", (F.col("_base") + F.col("_within")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, vocabulary: str, end_id: int, **columns: str) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    return read_ids(spark, folder, write_ids(docs, vocabulary, end_id, folder, **columns))
