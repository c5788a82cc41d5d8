"""Packing documents into token windows: bounded-space online packing.

A task keeps a fixed number of open windows. A document's full windows go out at once; what is left of
it goes whole into the open window it fits best. When none fits, the fullest window is topped up with
the head of the piece (unless the gap is under ``MIN_CUT``, which is padded) and goes out. The windows
still open at the end of a task are leftovers: the pieces of ``FAN_IN`` tasks are packed anew, largest
first, all but the ``OPEN`` emptiest windows go out, and so on, round after round, down to one task. What
meets in a task is at most ``FAN_IN`` times ``OPEN`` windows of piece descriptions (no tokens) at any
input size.

A round's pieces are written before the next one reads them, so a rerun task cannot contradict what
its first try sent on. Topping up needs token checksums, so it happens only where the tokens are at
hand (the first round); later rounds place whole pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bpe import Lexicon, encode_each, vocabulary
from .common import landed, ship

LENGTH = 2048
OPEN = 64
MIN_CUT = 16
FAN_IN = 16
END_ID = 1
class Encoder:
    """Token ids of texts with the end id, merged a slice of texts at a time (``bpe``). A worker keeps the
    vocabulary and nothing that grows with the texts it has seen."""

    def __init__(self, path: str):
        self.vocabulary, self.lexicon = vocabulary(path), Lexicon()

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text, the end id included."""
        end = np.array([END_ID], "<u4").tobytes()
        for ids in encode_each(self.vocabulary, self.lexicon, texts):
            yield ids + end

    def batch(self, texts: list[str | None]) -> list[bytes]:
        return list(self.each(texts))


class Packer:
    """Open windows, each a list of (size, piece) in order of placing."""

    def __init__(self, length: int, keep: int | None = None):
        self.length, self.keep = length, keep
        self.windows: list[list] = []
        self.room: list[int] = []

    def place(self, size: int, piece) -> bool:
        """Best fit; a new window while there are fewer than ``keep``."""
        best, least = -1, self.length + 1
        for i, r in enumerate(self.room):
            if size <= r < least:
                best, least = i, r
        if best < 0:
            if self.keep is not None and len(self.windows) >= self.keep:
                return False
            self.windows.append([])
            self.room.append(self.length)
            best = len(self.windows) - 1
        self.windows[best].append(piece)
        self.room[best] -= size
        return True

    def fullest(self) -> int:
        return min(range(len(self.room)), key=self.room.__getitem__)

    def out(self, i: int) -> list:
        self.room.pop(i)
        return self.windows.pop(i)


#: of a piece; id stands first, of the input's type
_PIECE = ("start", "length", "ids_crc32", "doc_tokens")
_COLUMNS = (*_PIECE, "task", "window", "offset", "open")


class _Sink:
    """Windows that went out, as rows."""

    def __init__(self, id_type: pa.DataType, task: int, level: int):
        self.id_type, self.task, self.first, self.sent, self.rows = id_type, task, level << 32, 0, []

    def send(self, window: list, open_: int = 0) -> None:
        offset = 0
        for p in window:
            self.rows.append((*p, self.task, self.first + self.sent, offset, open_))
            offset += p[2]
        self.sent += 1

    def flush(self) -> list[pa.Array]:
        columns = list(zip(*self.rows)) if self.rows else [()] * (1 + len(_COLUMNS))
        self.rows = []
        return [pa.array(columns[0], self.id_type), *(pa.array(c, pa.int64()) for c in columns[1:])]


def _pack_documents(path: str, length: int):
    def pack(batches):
        from pyspark import TaskContext

        encoder, packer, sink = Encoder(path), Packer(length, OPEN), None
        for batch in batches:
            sink = sink or _Sink(batch.schema.field("id").type, TaskContext.get().partitionId(), 0)
            texts = (t.as_py() for t in batch.column("text"))
            for id_, ids in zip(batch.column("id"), encoder.each(texts)):
                id_, total, at = id_.as_py(), len(ids) // 4, 0

                def piece(size):
                    return id_, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), total

                while total - at >= length:
                    sink.send([piece(length)])
                    at += length
                while at < total:
                    rest = total - at
                    if packer.place(rest, piece(rest)):
                        break
                    i = packer.fullest()
                    gap = packer.room[i]
                    if gap >= MIN_CUT:
                        packer.windows[i].append(piece(gap))
                        at += gap
                    sink.send(packer.out(i))
            yield pa.RecordBatch.from_arrays(sink.flush(), ["id", *_COLUMNS])
        if sink:
            for window in packer.windows:
                sink.send(window, 1)
            yield pa.RecordBatch.from_arrays(sink.flush(), ["id", *_COLUMNS])
    return pack


def _pack_leftovers(length: int, level: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("task", "ascending"), ("window", "ascending"),
                               ("offset", "ascending")])
        packer = Packer(length)
        for p in zip(*(table.column(c).to_pylist() for c in ("id", *_PIECE))):
            packer.place(p[2], p)
        sink = _Sink(table.schema.field("id").type, table.column("group")[0].as_py(), level)
        order = sorted(range(len(packer.windows)), key=packer.room.__getitem__)
        for at, i in enumerate(order):
            sink.send(packer.windows[i], int(at >= len(order) - OPEN))
        return pa.Table.from_arrays(sink.flush(), ["id", *_COLUMNS])
    return pack


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null or empty text: the end id alone, one piece. Null id: packed like any other, its pieces keep the
    null. Repeated rows: each is packed. Documents longer than a window are cut. Empty table: no rows.
    Other columns of docs are not kept (a piece is no row of docs).
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = StructType([StructField("id", rows.schema["id"].dataType), *(StructField(c, LongType()) for c in _COLUMNS)])
    first = landed(rows.mapInArrow(_pack_documents(tokenizer_path, length), out), "pack_pieces")
    done, open_ = first.where("open = 0"), first.where("open = 1")
    last = first.agg(F.max("task")).first()[0]
    level, groups = 0, 0 if last is None else last + 1
    while groups:
        level, groups = level + 1, -(-groups // FAN_IN)
        merged = landed(open_.withColumn("group", F.floor(F.col("task") / FAN_IN)).groupBy("group")
                        .applyInArrow(_pack_leftovers(length, level), out), "pack_leftovers")
        done, open_ = done.union(merged.where("open = 0")), merged.where("open = 1")
        if groups == 1:
            break
    return done.union(open_).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.shiftleft(F.col("task"), 40) + F.col("window")).alias("sequence_id"), "offset")
