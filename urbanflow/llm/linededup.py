"""Line dedup: lines whose key stands in many documents lose all their copies.

Every line sends a 128-bit hash of its key, the row it stands in, a hash of that document and its
position: no text. The rows are range-partitioned by (hash, row) and sorted by hash, row and position,
so that a very common line is spread over many partitions by its documents, rows that repeat one
document among them. A stream over each partition sees the first occurrence in each row and counts
it; the counts of a hash that spans partitions are added up. What returns is a compressed keep bitmap
for each document that loses a line; texts move once, to meet their bitmaps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_key, landed, packed, ship, unpacked

_SPACE = b" \t\n\x0b\x0c\r"


def key(line: bytes) -> bytes:
    """White space at both ends stripped, A-Z lower-cased."""
    return line.strip(_SPACE).lower()


#: bytes of text whose lines are hashed at once
SLICE = 2_000_000


def _emit(frames):
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    for frame in frames:
        texts, d1, d2 = frame["text"].tolist(), frame["d1"].to_numpy(), frame["d2"].to_numpy()
        hashes, docs, at, size = [], [], [], 0
        for i, text in enumerate(texts):
            for pos, line in enumerate(text.split(b"\n")):
                k = key(line)
                if k:
                    hashes.append(xxhash.xxh3_128_digest(k))
                    docs.append(i)
                    at.append(pos)
            size += len(text)
            if size >= SLICE or i == len(texts) - 1:
                raw = np.frombuffer(b"".join(hashes), ">i8").reshape(-1, 2).astype(np.int64)
                of = np.array(docs, np.int64)
                yield pd.DataFrame({"h1": raw[:, 0], "h2": raw[:, 1], "row": row + of, "d1": d1[of], "d2": d2[of],
                                    "pos": np.array(at, np.int64)})
                hashes, docs, at, size = [], [], [], 0
        row += len(texts)


def _mark_first(frames):
    """Rows arrive sorted by hash, row and position: flag the first of each (hash, row)."""
    last = None
    for frame in frames:
        if not len(frame):
            continue
        rows = frame[["h1", "h2", "row"]].to_numpy(np.int64)
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        first[0] = last is None or (rows[0] != last).any()
        last = rows[-1].copy()
        yield frame[["h1", "h2", "d1", "d2", "pos"]].assign(first=first.astype(np.int64))


def _bitmap(positions: pd.Series) -> pd.Series:
    """Keep bits of lines 0 up to the last dropped one (later lines stay), packed and compressed."""
    def one(dropped):
        bits = np.ones(-(-(int(max(dropped)) + 1) // 8) * 8, bool)
        bits[np.asarray(dropped, np.int64)] = False
        return zlib.compress(np.packbits(bits).tobytes())
    return positions.map(one)


def read_bitmap(data: bytes) -> np.ndarray:
    """Keep flag of each line the bitmap covers."""
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8)).astype(bool)


def _apply(texts: pd.Series, maps: pd.Series) -> pd.DataFrame:
    kept, lines, dropped = [], [], []
    for text, data in zip(texts, maps):
        text = text or b""
        parts = text.split(b"\n")
        lines.append(len(parts))
        if data is not None:
            gone = set(np.flatnonzero(~read_bitmap(data)).tolist())
            stay = [p for i, p in enumerate(parts) if i not in gone]
            dropped.append(len(parts) - len(stay))
            text = b"\n".join(stay)
        else:
            dropped.append(0)
        kept.append(text.decode("utf-8", "replace"))
    return pd.DataFrame({"text": kept, "n_lines": np.array(lines, np.int64), "n_dropped": np.array(dropped, np.int64)})


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_documents: int = 10) -> DataFrame:
    """(d1, d2, bitmap) of every document that loses a line (see ``document_key``)."""
    ship(docs.sparkSession)
    text = F.col(text_col)
    lines = (docs.where(text != "").select(*document_key(F.col(id_col), text), text.cast("binary").alias("text"))
             .mapInPandas(_emit, "h1 long, h2 long, row long, d1 long, d2 long, pos long")
             .repartitionByRange("h1", "h2", "row").sortWithinPartitions("h1", "h2", "row", "pos"))
    marked = landed(lines.mapInPandas(_mark_first, "h1 long, h2 long, d1 long, d2 long, pos long, first long"), "lines")
    # landed, so that the join deals out both of its sides and can split a hash that is in very many documents
    common = landed(marked.groupBy("h1", "h2").agg(F.sum("first").alias("documents"))
                    .where(F.col("documents") >= min_documents).select("h1", "h2"), "common_lines")
    dropped = marked.join(common, ["h1", "h2"]).groupBy("d1", "d2").agg(F.collect_set("pos").alias("dropped"))
    return dropped.select("d1", "d2", F.pandas_udf(_bitmap, "binary")("dropped").alias("bitmap"))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_documents: int = 10) -> DataFrame:
    """docs with text reduced to the lines that stay (joined by \\n), n_lines and n_dropped.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys of at least
    one character in at least ``min_documents`` documents lose all their lines. Null or empty text:
    one empty line, kept text empty. Null id: a document like any other. Every row is a document: rows that
    repeat (same id and text) count each, and lose the same lines. Several copies of a line in one document
    count once and go together. Empty table: no rows.
    """
    ship(docs.sparkSession)
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_documents)
    others = [c for c in docs.columns if c.lower() != text_col.lower()]
    rows = docs.select(packed(docs, others), *document_key(F.col(id_col), F.col(text_col)),
                       F.col(text_col).cast("binary").alias("raw"))
    done = rows.join(bitmaps, ["d1", "d2"], "left").select("__in", F.pandas_udf(_apply, "text string, n_lines long, n_dropped long")("raw", "bitmap")
                         .alias("done"))
    return unpacked(done.select("__in", F.col("done.text").alias(text_col), "done.n_lines", "done.n_dropped"),
                    [text_col, "n_lines", "n_dropped"])
