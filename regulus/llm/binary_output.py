"""Token ids as length-delimited binary records with checksums, and a separate index for reads in any order.

A record file is a run of frames: the payload's length (8 bytes), the masked checksum of those bytes (4), the payload, and its masked
checksum (4); all little-endian. A payload is a flag and 8 bytes for the document's id, one byte for the width of a token, and the
tokens. An index file holds 16 bytes per record: where the frame begins and how long it is. A task writes its files under a name of
its own attempt and renames them at the end, so an attempt repeated after a loss leaves the same files.
"""
from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulus.llm.store import shared_path, written
from regulus.llm.tokens import encoded, vocabulary_path
from regulus.session import removed_at_exit

#: The id behind every document.
END = 2
_HEAD = struct.Struct("<QI")
_PAYLOAD = struct.Struct("<?qB")
_INDEX = struct.Struct("<QQ")
MANIFEST = "part int, name string, n_records long, n_tokens long, n_bytes long"
RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    """A checksum that does not become that of a record which itself holds checksums."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    payload = _PAYLOAD.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def index_entry(at: int, n: int) -> bytes:
    return _INDEX.pack(at, n)


def unframed(read) -> tuple[int | None, np.ndarray] | None:
    """The next record of ``read(n)``; None at the end, an error where a checksum does not fit."""
    head = read(_HEAD.size)
    if not head:
        return None
    n, crc = _HEAD.unpack(head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length is damaged")
    payload, crc = read(n), struct.unpack("<I", read(4))[0]
    if masked(payload) != crc:
        raise ValueError("a record is damaged")
    present, doc_id, width = _PAYLOAD.unpack_from(payload)
    return doc_id if present else None, np.frombuffer(payload, dtype=f"<u{width}", offset=_PAYLOAD.size).astype("<u4")


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there. Arrow knows Spark's s3a and s3n paths as s3; file, hdfs, gs and abfs(s) have one name in both."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


def write_records(df: DataFrame, folder: str, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Write the texts of ``df`` in ascending order of id (null first, equal ids by text) and return the manifest, one row per file.

    A null text is empty, so its record holds the end id alone. Repeated rows get a record each.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # a hot or null id is split by the text, and equal rows by their place, which does not change what is written
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange("doc_id", "hash", "place").sortWithinPartitions("doc_id", "hash", "place").select("doc_id", "text")

    def write(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}"
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        trial = f"{base}/{name}-{task.taskAttemptId()}"
        records = tokens = at = 0
        path = vocabulary or vocabulary_path()
        with store.open_output_stream(trial + ".records") as out, store.open_output_stream(trial + ".index") as index:
            for batch in batches:
                for own, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"), path)):
                    frame = framed(own, np.append(ids, np.uint32(end)))
                    out.write(frame)
                    index.write(index_entry(at, len(frame)))
                    records, tokens, at = records + 1, tokens + len(ids) + 1, at + len(frame)
        for kind in (".records", ".index"):
            if records:
                store.move(trial + kind, f"{base}/{name}{kind}")
            else:
                store.delete_file(trial + kind)
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([records]), pa.array([tokens]),
                                              pa.array([at])], names=["part", "name", "n_records", "n_tokens", "n_bytes"])

    return written(rows.mapInArrow(write, MANIFEST), "manifest")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files of ``manifest``: doc_id, start, n_tokens and the checksum of its ids as 32-bit integers."""
    # a row per file; its window is over files, not over documents
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("name", "n_records", F.coalesce(before, F.lit(0)).alias("before")).repartition(F.col("name"))

    def read(batches):
        store, base = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, found, n = row["before"], [], 0
                with store.open_input_stream(f"{base}/{row['name']}.records", buffer_size=1 << 20) as stream:
                    while (record := unframed(stream.read)) is not None:
                        own, ids = record
                        found.append((own, start, len(ids), zlib.crc32(ids.tobytes())))
                        start, n = start + len(ids), n + 1
                        if len(found) == 10_000:
                            yield _records(found)
                            found = []
                if n != row["n_records"]:
                    raise ValueError(f"{row['name']} holds {n} records of {row['n_records']}")
                yield _records(found)

    return files.mapInArrow(read, RECORDS)


def _records(found: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(4)], names=names)


def read_at(folder: str, name: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records of one file by number, in the order asked for, found through the index."""
    store, base = _store(folder)
    out = []
    with store.open_input_file(f"{base}/{name}.index") as index, store.open_input_file(f"{base}/{name}.records") as records:
        for k in numbers:
            index.seek(k * _INDEX.size)
            at, _ = _INDEX.unpack(index.read(_INDEX.size))
            records.seek(at)
            out.append(unframed(records.read))
    return out


def records_of(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the documents and read them back. The files go with the session."""
    folder = shared_path(df.sparkSession, "records")
    manifest = write_records(df, folder, vocabulary=vocabulary)
    removed_at_exit(df.sparkSession, folder)
    return read_records(manifest, folder)
