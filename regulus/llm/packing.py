"""Token sequences packed into windows online, in bounded space.

Each partition keeps a fixed number of open windows. A document fills whole windows as long as it can; what is left goes to the open
window it fits best. When it fits none, the fullest window is completed with its head and emitted, and its tail opens a new window.
What stays open at the end of the partitions, with its ids, is merged by the same rule in rounds of groups of partitions, until one
group is left and is emitted whole: all sequences are full but its last one.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from regulus.llm.store import written
from regulus.llm.tokens import encoded, vocabulary_path

#: Tokens of a sequence, open windows of a partition, partitions merged at a time, the id that ends a document.
LENGTH, OPEN, MERGED, END = 1024, 8, 64, 0

PIECE = [("start", LongType()), ("length", LongType()), ("ids_crc32", LongType()), ("doc_tokens", LongType()),
         ("sequence_id", LongType()), ("offset", LongType())]


class Windows:
    """The open windows of one partition. A window is a list of pieces: (carried values, start, ids, tokens of the document)."""

    def __init__(self, length: int, most: int, first_id: int) -> None:
        self.length, self.most, self.next_id = length, most, first_id
        self.open: list[list] = []  # [free, pieces]

    def _emit(self, pieces: list) -> Iterator[tuple]:
        offset, number = 0, self.next_id
        self.next_id += 1
        for carried, start, ids, total in pieces:
            yield carried, start, ids, total, number, offset
            offset += len(ids)

    def add(self, carried, start: int, ids: np.ndarray, total: int) -> Iterator[tuple]:
        """Place ids of a document; the pieces of the windows that this completes."""
        while len(ids) >= self.length:
            yield from self._emit([(carried, start, ids[:self.length], total)])
            start, ids = start + self.length, ids[self.length:]
        while len(ids):
            fitting = [w for w in self.open if w[0] >= len(ids)]
            if fitting:
                window = min(fitting, key=lambda w: w[0])
            elif len(self.open) < self.most:
                window = [self.length, []]
                self.open.append(window)
            else:
                window = min(self.open, key=lambda w: w[0])
            n = min(window[0], len(ids))
            window[1].append((carried, start, ids[:n], total))
            window[0] -= n
            start, ids = start + n, ids[n:]
            if window[0] == 0:
                self.open.remove(window)
                yield from self._emit(window[1])

    def rest(self) -> Iterator[tuple]:
        for _, pieces in sorted(self.open, key=lambda w: w[0]):
            yield from self._emit(pieces)
        self.open = []


def _row(piece: tuple) -> list[int]:
    _, start, ids, total, number, offset = piece
    return [start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, offset]


def pack(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None,
         length: int = LENGTH, open_windows: int = OPEN, merged: int = MERGED, end: int = END) -> DataFrame:
    """One row per piece: the columns named in ``carry``, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    Every document ends with the id ``end``; a null or empty text is that id alone. Repeated rows are packed each on its own. Columns not
    carried are left out, so none can clash; a carried one may not have a name of the result. An empty table gives an empty one.
    """
    clash = {*carry} & {*[n for n, _ in PIECE], "is_open", "part", "ids"}
    if clash or len({*carry}) < len(carry):
        raise ValueError(f"these columns cannot be carried under their names: {sorted(clash) or list(carry)}")
    carried_fields = [df.schema[c] for c in carry]
    schema = StructType([*carried_fields, *[StructField(n, t) for n, t in PIECE],
                         StructField("is_open", BooleanType()), StructField("part", IntegerType()), StructField("ids", BinaryType())])

    def place(batches):
        part = TaskContext.get().partitionId()
        windows = Windows(length, open_windows, part << 32)
        path = vocabulary or vocabulary_path()
        types = None

        def batch_of(pieces, is_open):
            columns = [pa.array([p[0][k] for p in pieces], t) for k, t in enumerate(types)]
            numbers = np.array([_row(p) for p in pieces], dtype=np.int64).reshape(-1, len(PIECE))
            ids = [p[2].astype("<u4").tobytes() if is_open else None for p in pieces]
            return pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(numbers[:, k]) for k in range(len(PIECE))], pa.array([is_open] * len(pieces), pa.bool_()),
                 pa.array([part] * len(pieces), pa.int32()), pa.array(ids, pa.binary())], names=schema.names)

        for batch in batches:
            types = [batch.schema.field(c).type for c in carry]
            values = list(zip(*[batch.column(c).to_pylist() for c in carry])) if carry else [()] * batch.num_rows
            pieces = []
            for value, ids in zip(values, encoded(batch.column(text), path)):
                ids = np.append(ids, np.uint32(end))
                pieces.extend(windows.add(value, 0, ids, len(ids)))
                if len(pieces) > 4096:
                    yield batch_of(pieces, False)
                    pieces = []
            if pieces:
                yield batch_of(pieces, False)
        if windows.open:
            yield batch_of(list(windows.rest()), True)

    # other columns than these do not reach Python
    placed = written(df.select(*carry, text).mapInArrow(place, schema), "packed")
    done, rest, round_ = [placed.where("not is_open")], placed.where("is_open"), 0
    while True:
        round_ += 1
        most = rest.agg(F.max("part")).first()[0]
        if most is None:
            break
        last = most < merged
        merging = rest.withColumn("part", F.floor(F.col("part") / merged).cast("int"))
        rest = written(merging.groupBy("part").applyInArrow(_merge(carry, schema, length, open_windows, round_, last), schema), "merged")
        done.append(rest.where("not is_open"))
        if last:
            break
        rest = rest.where("is_open")
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out.drop("is_open", "part", "ids")


def _merge(carry, schema: StructType, length: int, open_windows: int, round_: int, last: bool):
    """Repack the open pieces of a group of partitions: at most ``merged`` x ``open_windows`` windows."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        part = table["part"][0].as_py()
        # in the last round pieces may be cut at any place, so one open window is enough and only the last sequence is not full
        windows = Windows(length, 1 if last else open_windows, (1 << 62) + (round_ << 56) + (part << 32))
        rows = []

        def keep(pieces, is_open):
            for p in pieces:
                rows.append([*p[0], *_row(p), is_open, part, p[2].astype("<u4").tobytes() if is_open else None])

        values = list(zip(*[table[c].to_pylist() for c in carry])) if carry else [()] * table.num_rows
        for value, start, total, ids in zip(values, table["start"].to_pylist(), table["doc_tokens"].to_pylist(), table["ids"].to_pylist()):
            keep(windows.add(value, start, np.frombuffer(ids, dtype="<u4"), total), False)
        keep(list(windows.rest()), not last)
        kinds = [table.schema.field(name).type for name in schema.names]
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=schema.names)

    return run
