"""BPE encoding and decoding by a minimal acyclic transducer of frequent words.

The words of the whole corpus are counted in Spark; the most frequent ones (at most ``LEXICON``) and their
token ids are compiled, in sorted order, into an acyclic transducer: bytes of a word on the arcs, ids as
outputs pushed as near to the root as they are common, states with the same arcs, outputs and ends shared.
It is one flat file of 32-bit numbers that the executors fetch once and their Python workers memory-map, so
that workers of a machine share its pages. A word outside it is merged pair by pair, lowest rank first and
leftmost on ties, as the vocabulary's own rules say; so the lexicon decides on speed alone, never on ids.

All words of a slice of texts walk the automaton together, and all unseen ones are merged together (numpy);
each distinct word of a slice is looked up once.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..session import scratch_path
from .common import IN, discard, landed_at, packed, ship, unpacked

#: words of the lexicon, at most
LEXICON = 1 << 17
#: characters of text that a worker takes on at once
SLICE = 1_500_000
#: words that a worker counts before it hands the counts on
COUNTED = 150_000
#: words of more bytes are merged one by one, with a heap
LONG = 64
#: steps of the count histogram per doubling
STEPS = 16

_NONE = np.iinfo(np.int32).max
#: widths of the blocks of words that are merged together, and their rows at most
_WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40, LONG)
_ROWS = 8192
_HEAD = 5

#: fixed values: normalizer and pre-tokenizer whose words ``_PLAIN`` finds in plain texts
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: plain texts hold no character from here on, lower-cased or not: they are composed, and lower-cased one by one
_PLAIN_END = "ɐ"
_BELOW = [chr(c) for c in range(ord(_PLAIN_END))]
_LETTERS = "".join(c for c in _BELOW if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _BELOW if unicodedata.category(c)[0] == "N")
_SPACES = "\\x20\\x09-\\x0D\\x85\\xA0"
_PLAIN = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_OTHER = re.compile(f"[{_PLAIN_END}-\U0010ffff]")
_BREAK = re.compile("[\\x20\\x09-\\x0D]")


def byte_names() -> list[str]:
    """The character by which a byte-level vocabulary names each byte: itself where it prints, else one from
    U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of a byte-level BPE tokenizer file, and its words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError(f"{path}: not a plain BPE vocabulary")
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must stand as they are in the raw text")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.added.values()])
        names: list[str | None] = [None] * size
        for t, i in [*vocab.items(), *self.added.items()]:
            names[i] = t
        self.names = pa.array(names, pa.string())
        byte = byte_names()
        self.bytes_of = {c: b for b, c in enumerate(byte)}
        self.inner = np.array([vocab[c] for c in byte], np.int32)
        self.last = np.array([vocab[c + suffix] for c in byte], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        left, right, out = (np.array([vocab[t] for t in ts], np.int64) for ts in
                            ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        self.size, self.product = size, out
        keys = left * size + right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.rank_of, self.product = self.rank_of.astype(np.int32), self.product.astype(np.int32)
        # a byte inside a word is symbol 0 to 255, at its end 256 to 511, padding 512; ranks of all their pairs
        self.symbol = np.concatenate((self.inner, self.last, [-1])).astype(np.int32)
        self.first_ranks = self._ranks(*np.broadcast_arrays(self.symbol[:, None], self.symbol[None, :]))
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or "(?!)")
        self.known_split = spec["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZER} and (
            [p.get("pattern") for p in spec["pre_tokenizer"].get("pretokenizers", [])] == [{"Regex": _SPLIT}, None])
        self.path, self._whole = path, None

    # -- words ---------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Normalized words of a text, added tokens among them as they stand."""
        if "<" not in text or not self.special.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._split(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        low = text.lower()
        if self.known_split and not (_OTHER.search(text) or _OTHER.search(low)):
            return _PLAIN.findall(low)
        if self._whole is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        if self._whole.normalizer is not None:
            text = self._whole.normalizer.normalize_str(text)
        back = self.bytes_of
        return [bytes([back[c] for c in w]).decode("utf-8", "surrogateescape")
                for w, _ in self._whole.pre_tokenizer.pre_tokenize_str(text)]

    # -- merging -------------------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        sizes = np.array([len(w) for w in words], np.int64)
        return self.merge_flat(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def merge_flat(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge``, of words that lie in flat bytes."""
        found: list[tuple] = []  # (words, number of ids of each, ids in a row)
        low = 0
        for high in _WIDTHS:
            rows = np.flatnonzero((size > low) & (size <= high))
            for part in np.split(rows, range(_ROWS, len(rows), _ROWS)):
                if len(part):
                    self._merge_block(flat, start[part], size[part], part, found)
            low = high
        for i in np.flatnonzero(size > LONG):
            ids = self._merge_long(flat[start[i]:start[i] + size[i]].tobytes())
            found.append((np.array([i]), np.array([len(ids)]), ids))
        counts = np.zeros(len(size), np.int64)
        for rows, n, _ in found:
            counts[rows] = n
        out = np.empty(int(counts.sum()), np.int32)
        at = np.cumsum(counts) - counts
        for rows, n, ids in found:
            out[spread(at[rows], n)] = ids
        return out, counts

    def _merge_block(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray, rows: np.ndarray, found: list) -> None:
        """One merge a word and round, all words at once; a word without a pair to merge leaves."""
        width = int(size.max())
        code = np.full((len(rows), width), 512, np.int16)
        code[np.arange(width) < size[:, None]] = flat[spread(start, size)]
        code[np.arange(len(rows)), size - 1] += 256
        sym = self.symbol[code]
        rank = np.full((len(rows), max(width - 1, 1)), _NONE, np.int32)
        if width > 1:
            rank[:] = self.first_ranks[code[:, :-1], code[:, 1:]]
        while True:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                done = sym[over]
                found.append((rows[over], (done >= 0).sum(axis=1), done[done >= 0]))
                go = ~over
                rows, sym, rank, at, best = rows[go], sym[go], rank[go], at[go], best[go]
                if not len(rows):
                    return
            each, width = np.arange(len(rows)), sym.shape[1] - 1
            sym[each, at] = self.product[best]
            column = np.arange(width)
            sym = sym[each[:, None], column + (column > at[:, None])]
            if width == 1:
                rank[:] = _NONE
                continue
            column = column[:-1]
            rank = rank[each[:, None], column + (column >= at[:, None])]
            for p in (at - 1, at):
                ok = (p >= 0) & (p < width - 1)
                r, c = each[ok], p[ok]
                rank[r, c] = self._ranks(sym[r, c], sym[r, c + 1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One word by a heap of its pairs; a pair whose sides have changed since is passed over."""
        flat = np.frombuffer(word, np.uint8)
        sym = [*self.inner[flat[:-1]].tolist(), int(self.last[flat[-1]])]
        after, before = [*range(1, len(sym)), -1], [*range(-1, len(sym) - 1)]
        ranks = self._ranks(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(ranks[i]), int(i), sym[i], sym[i + 1]) for i in np.flatnonzero(ranks != _NONE)]
        heapq.heapify(heap)
        keys, rank_of = self.keys, self.rank_of
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.product[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    key = sym[x] * self.size + sym[y]
                    at = int(np.searchsorted(keys, key))
                    if at < len(keys) and keys[at] == key:
                        heapq.heappush(heap, (int(rank_of[at]), x, sym[x], sym[y]))
        return np.array([s for s in sym if s >= 0], np.int32)


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once a process (the last one is kept)."""
    if path not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


# -- the transducer --------------------------------------------------------------------------------------


class _Node:
    __slots__ = ("arcs", "end")

    def __init__(self):
        self.arcs: list[list] = []  # [byte, output, state]
        self.end: tuple | None = None  # what remains to be put out if a word ends here


def compile_transducer(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> np.ndarray:
    """The minimal acyclic transducer of (word, ids), words distinct and in byte order, as one array.

    Only the states along the last word are open. When the next word branches off, those below the branch
    can get no more arcs and become numbered states, or are replaced by an equal one.
    """
    numbers: dict[tuple, int] = {}
    path, last = [_Node()], b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1].arcs[-1][2] = number(node)

    def number(node: _Node) -> int:
        return numbers.setdefault((node.end, tuple((b, o, s) for b, o, s in node.arcs)), len(numbers))

    for word, out in entries:
        if word <= last:
            raise ValueError("words must be distinct, not empty and in byte order")
        shared = len(os.path.commonprefix((last, word)))
        close(shared)
        for node, child in zip(path, path[1:]):  # what the words have in common stays, the rest moves down
            arc = node.arcs[-1]
            common = len(os.path.commonprefix((arc[1], out)))
            rest = arc[1][common:]
            if rest:
                for a in child.arcs:
                    a[1] = rest + a[1]
                if child.end is not None:
                    child.end = rest + child.end
            arc[1], out = arc[1][:common], out[common:]
        for b in word[shared:]:
            path[-1].arcs.append([b, out, -1])
            out = ()
            path.append(_Node())
        path[-1].end = out
        last = word
    close(0)
    root = number(path[0])
    pool: dict[tuple, int] = {(): 0}
    flat: list[int] = []

    def place(out: tuple) -> int:
        if out not in pool:
            pool[out] = len(flat)
            flat.extend(out)
        return pool[out]

    arcs = [(s * 256 + b, target, place(out), len(out)) for (_, row), s in numbers.items() for b, out, target in row]
    arcs.sort()
    ends = np.zeros((3, len(numbers)), np.uint32)
    for (end, _), s in numbers.items():
        if end is not None:
            ends[:, s] = 1, place(end), len(end)
    table = np.array(arcs, np.uint32).reshape(-1, 4).T
    head = np.array([len(arcs), len(numbers), len(flat), root, 0], np.uint32)
    return np.concatenate([head, table.ravel(), ends.ravel(), np.array(flat, np.uint32)])


class Lexicon:
    """A compiled transducer: an array, or a file that is memory-mapped; by default one without words."""

    def __init__(self, source: np.ndarray | str | None = None):
        if source is None:
            source = compile_transducer([])
        a = np.memmap(source, np.uint32, "r") if isinstance(source, str) else source
        arcs, states, pool, self.root = (int(x) for x in a[:4])
        at = _HEAD
        self.keys, self.targets, self.starts, self.sizes = (a[at + i * arcs:at + (i + 1) * arcs] for i in range(4))
        at += 4 * arcs
        self.ends, self.end_starts, self.end_sizes = (a[at + i * states:at + (i + 1) * states] for i in range(3))
        self.pool = a[at + 3 * states:at + 3 * states + pool]
        self.states = states

    def look_up(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words that lie in flat bytes between offsets: (known, number of ids, ids of all known in a row)."""
        words = len(offsets) - 1
        size = np.diff(offsets)
        known = np.zeros(words, bool)
        found: list[tuple] = []  # (words, starts, sizes) of outputs, in order of the bytes read
        rows, step = np.flatnonzero(size > 0), 0
        state = np.full(len(rows), self.root, np.int64)
        while len(rows) and len(self.keys):
            key = (state * 256 + flat[offsets[rows] + step]).astype(np.uint32)
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            rows, arc = rows[hit], arc[hit]
            found.append((rows, self.starts[arc], self.sizes[arc]))
            state, step = self.targets[arc].astype(np.int64), step + 1
            last = size[rows] == step
            done, at = rows[last], state[last]
            ends = self.ends[at] == 1
            known[done[ends]] = True
            found.append((done[ends], self.end_starts[at[ends]], self.end_sizes[at[ends]]))
            rows, state = rows[~last], state[~last]
        if not found:
            return known, np.zeros(words, np.int64), np.zeros(0, np.int64)
        row, start, length = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in range(3))
        some = known[row] & (length > 0)
        row, start, length = row[some], start[some], length[some]
        order = np.argsort(row, kind="stable")
        row, start, length = row[order], start[order], length[order]
        return known, np.bincount(row, weights=length, minlength=words).astype(np.int64), self.pool[spread(start, length)].astype(np.int64)


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, runs in a row."""
    return np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))


def encode_words(vocab: Vocabulary, lexicon: Lexicon, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, offset of each word's ids and the end) of distinct words."""
    raw = words.cast(pa.binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    flat = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
    known, counts, ids = lexicon.look_up(flat, offsets)
    unseen = np.flatnonzero(~known)
    size = np.diff(offsets)[unseen]
    merged, sizes = vocab.merge_flat(flat, offsets[:-1][unseen], size)
    special = [(w, i) for t, i in vocab.added.items()
               for w in np.flatnonzero((size == len(t.encode())) & (flat[offsets[:-1][unseen]] == t.encode()[0]))
               if words[int(unseen[w])].as_py() == t] if len(unseen) else []
    for w, i in special:  # an added token is one id, whatever its text would merge to
        before = int(sizes[:w].sum())
        merged = np.concatenate((merged[:before], [i], merged[before + sizes[w]:]))
        sizes[w] = 1
    counts[unseen] = sizes
    out = np.empty(int(counts.sum()), np.int32)
    start = np.cumsum(counts) - counts
    seen = np.flatnonzero(known)
    out[spread(start[seen], counts[seen])] = ids
    out[spread(start[unseen], sizes)] = merged
    return out, np.append(start, len(out))


def encode_texts(vocab: Vocabulary, lexicon: Lexicon, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, offset of each text's ids and the end)."""
    words, ends = [], []
    for t in texts:
        words += vocab.words(t)
        ends.append(len(words))
    coded = pa.array(words, pa.string()).dictionary_encode()
    ids, offsets = encode_words(vocab, lexicon, coded.dictionary)
    codes = coded.indices.to_numpy()
    sizes = np.diff(offsets)[codes]
    at = np.concatenate(([0], np.cumsum(sizes)))
    return ids[spread(offsets[:-1][codes], sizes)].astype("<u4"), at[np.array([0, *ends])]


def encode_each(vocab: Vocabulary, lexicon: Lexicon, texts: Iterable[str | None]) -> Iterator[bytes]:
    """Ids of each text, in order, as little-endian unsigned 32-bit integers; a null text is an empty one."""
    now, held = 0, []
    for part, of in slices(texts, SLICE):
        ids, at = encode_texts(vocab, lexicon, part)
        raw, at = memoryview(ids.tobytes()), (4 * at).tolist()
        for i, a, b in zip(of, at, at[1:]):
            if i != now:
                yield b"".join(held)
                now, held = i, []
            held.append(raw[a:b])
    if held:
        yield b"".join(held)


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at white space, which no word spans."""
    at = 0
    while len(text) - at > size:
        m = _BREAK.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:] if at else text


def slices(texts: Iterable[str | None], size: int) -> Iterator[tuple[list[str], list[int]]]:
    """(pieces, index of the text of each), in order, about ``size`` characters at a time."""
    part, of, length = [], [], 0
    for i, t in enumerate(texts):
        for p in pieces(t or "", size):
            part.append(p)
            of.append(i)
            length += len(p)
            if length >= size:
                yield part, of
                part, of, length = [], [], 0
    if part:
        yield part, of


# -- Spark -------------------------------------------------------------------------------------------------


def _count_words(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, counts = vocabulary(path), Counter()

        def out():
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return found

        for batch in batches:
            for part, _ in slices((t.as_py() for t in batch.column(0)), SLICE):
                for p in part:
                    counts.update(vocab.words(p))
                if len(counts) > COUNTED:
                    yield out()
        yield out()
    return count


def frequent_words(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON) -> list[str]:
    """The most frequent words of all texts, at most ``size``: all words of so many occurrences, where the
    least number is the smallest step of a logarithmic histogram that keeps the bound. So no ranking of all
    words is needed, and ties come in or stay out together."""
    spark = docs.sparkSession
    words, at = landed_at(
        docs.select(F.col(text_col).alias("text")).mapInArrow(_count_words(path), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).withColumn("step", F.floor(F.log2("n") * STEPS)), "bpe_words")
    room, least = size, None
    for r in sorted(words.groupBy("step").count().collect(), reverse=True):  # at most 64 * STEPS rows
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    chosen = [] if least is None else [r["word"] for r in words.where(F.col("step") >= least).select("word").collect()]
    discard(spark, at)
    return chosen


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON) -> str:
    """Compiles the frequent words of docs; the name of the file that Spark has sent to every executor.

    The driver holds ``size`` words and their automaton, whatever the size of docs. An empty table, or texts
    without words, give an empty lexicon.
    """
    spark = docs.sparkSession
    ship(spark)
    vocab = vocabulary(path)
    words = sorted(w.encode() for w in frequent_words(docs, path, text_col, size) if w not in vocab.added)
    ids, counts = vocab.merge(words)
    ends = np.cumsum(counts).tolist()
    ids = ids.tolist()
    return _send(spark, compile_transducer((w, tuple(ids[e - n:e])) for w, e, n in zip(words, ends, counts.tolist())))


def _send(spark: SparkSession, lexicon: np.ndarray) -> str:
    """Written into the shared scratch folder, from where each executor fetches it once."""
    at = scratch_path(spark, "llm", "bpe_lexicon")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(lexicon.astype("<u4").tobytes()))
    out.close()
    spark.sparkContext.addFile(at)
    return at.rsplit("/", 1)[1]


def row_slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes in a text or binary column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, before + size, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _encode_rows(path: str, name: str, decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        vocab, lexicon = vocabulary(path), Lexicon(SparkFiles.get(name))
        for batch in batches:
            for part in row_slices(batch, "text", SLICE):
                ids = pa.array(list(encode_each(vocab, lexicon, (t.as_py() for t in part.column("text")))), pa.binary())
                out = [part.column(IN), ids, *([decode_column(vocab.names, ids)] if decoded else [])]
                yield pa.RecordBatch.from_arrays(out, [IN, "ids", "decoded"][:len(out)])
    return encode


def encode(docs: DataFrame, path: str, lexicon: str | None = None, text_col: str = "text",
           carry: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """Every row of docs with ``ids``: its token ids as little-endian unsigned 32-bit integers, no special
    tokens added; added tokens of the vocabulary that stand in a text are encoded as such. ``decoded``: also
    the text that the ids decode to (see ``decode``), in the same pass.

    lexicon: the name that ``build_lexicon`` gave; by default that of docs. Null or empty text: no ids.
    Repeated rows: each is encoded. Texts of any length, in slices. Empty table: no rows. Columns as
    ``unpacked`` says.
    """
    ship(docs.sparkSession)
    name = lexicon or build_lexicon(docs, path, text_col)
    results = [StructField("ids", BinaryType()), *([StructField("decoded", StringType())] if decoded else [])]
    rows = _mapped(docs, carry, F.col(text_col).alias("text"), _encode_rows(path, name, decoded), results)
    return unpacked(rows, [r.name for r in results])


def _mapped(df: DataFrame, carry: list[str] | None, column: Column, task, results: list[StructField]) -> DataFrame:
    """The packed row and results of a task over (packed row, column)."""
    rows = df.select(packed(df, carry), column)
    return rows.mapInArrow(task, StructType([rows.schema[IN], *results]))


def decode_ids(names: pa.StringArray, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Token names joined by one blank: what a tokenizer without a decoder does. Ids without a token go."""
    valid = ids < len(names)
    before = np.concatenate(([0], np.cumsum(valid)))
    lists = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), names.take(pa.array(ids[valid])))
    return pc.binary_join(lists, " ").to_pylist()


def decode_column(names: pa.StringArray, column: pa.BinaryArray) -> pa.StringArray:
    """The texts of ids, a bounded number of ids at a time; null for null."""
    found: list[list[str] | None] = [None] * len(column)
    part, of, size = [], [], 0

    def out():
        at = np.cumsum([0, *[len(p) // 4 for p in part]])
        for i, text in zip(of, decode_ids(names, np.frombuffer(b"".join(part), "<u4"), at)):
            if text:
                found[i].append(text)

    for i, value in enumerate(column):
        raw = value.as_py()
        if raw is None:
            continue
        found[i] = []
        for begin in range(0, len(raw), SLICE):
            part.append(raw[begin:begin + SLICE])
            of.append(i)
            size += len(part[-1])
            if size >= SLICE:
                out()
                part, of, size = [], [], 0
    out()
    return pa.array([None if f is None else " ".join(f) for f in found], pa.string())


def _decode_rows(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = vocabulary(path).names
        for batch in batches:
            for part in row_slices(batch, "ids", SLICE):
                yield pa.RecordBatch.from_arrays([part.column(IN), decode_column(names, part.column("ids"))], [IN, "decoded"])
    return decode


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """Every row of encoded with ``decoded``: the text of its ids, special tokens included. Null ids: null; no
    ids: empty. Columns as ``unpacked`` says."""
    ship(encoded.sparkSession)
    return unpacked(_mapped(encoded, carry, F.col(ids_col).alias("ids"), _decode_rows(path), [StructField("decoded", StringType())]), ["decoded"])
