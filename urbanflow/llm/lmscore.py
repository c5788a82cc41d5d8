"""Language-model scores by masked pseudo-likelihood.

A bidirectional window network, trained in numpy, predicts every token from the ``SIDE`` tokens on
either side of it: each neighbour's embedding goes through the weights of its position, their sum
through a tanh layer, and a softmax gives the token's class. A second softmax from the same layer, over the
tokens of that class, gives the token; it starts from their shares of the corpus counts. So
log p(token | both sides) = log p(class | both sides) + log p(token | class, both sides). A document's score
is the sum over its tokens.

Vocabulary: the ``VOCABULARY`` most frequent words by exact counts over all documents, among those that
make up at least ``MIN_SHARE`` of them (which bounds what is sorted); every other word
is one of ``RARE`` tokens by hash to the network, and log p(word | token) comes on top: its share of the
token's exact count, joined from the table of all words (it is never held whole). A token keeps one count for
the words that the corpus lacks. Classes hold about equal shares of the corpus.

Words are split once to count and once to number them; the numbers are landed, and training and scoring read
them alone.

Training covers all documents: in each of ``ROUNDS`` every task walks its own documents from the common
weights, on every ``ROUNDS``-th position (another set in each round, so that each position is predicted
once), and the tasks' weights are averaged by positions seen, a slice of the weights of ``FAN_IN`` tasks at a time. What is gathered grows with the
corpus (word counts of every task, weights of every task); what is broadcast is the model alone, of a
size set by the constants.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed, packed, ship, unpacked

VOCABULARY, RARE, CLASSES = 8192, 64, 64
MIN_SHARE = 1e-7
SIDE, WIDTH, HIDDEN = 2, 16, 32
ROUNDS = 2
MINIBATCH, RATE = 1024, 0.07
SLICES = 32
#: tasks whose weights are averaged in one group
FAN_IN = 64
SEED = 42
#: words that a counting task holds before it sends what it has; tokens scored at a time
HELD, BATCH = 500_000, 16_384
#: documents that a task lays end to end
SLICE = 500
#: tokens of neighbouring classes that are multiplied as one block; logits whose exponentials are taken as they are
BLOCK, SAFE = 64, 40
#: steps of a rare word's log-share (whole numbers, so that sums do not depend on their order)
UNIT = 10 ** 9

_SHAPES = (("emb", (VOCABULARY + RARE + 1, WIDTH)), ("inner", (2 * SIDE, WIDTH, HIDDEN)), ("bias", (HIDDEN,)),
           ("outer", (HIDDEN, CLASSES)), ("out_bias", (CLASSES,)), ("words", (VOCABULARY + RARE, HIDDEN)))
PAD = VOCABULARY + RARE


def tokens(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return data.lower().split() if data else []


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all texts (binary) end to end, and how many each has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words, lengths = split.flatten(), pc.list_value_length(split).fill_null(0).to_numpy().astype(np.int64)
    full = pc.binary_length(words).to_numpy() > 0  # before and after white space at the ends there are empty ones
    if not full.all():
        words = words.filter(pa.array(full))
        cuts = np.concatenate(([0], np.cumsum(full)))
        ends = np.cumsum(lengths)
        lengths = cuts[ends] - cuts[ends - lengths]
    return words.view(pa.binary()), lengths


class Vocabulary:
    """Token numbers of words, class and log-share of each token."""

    def __init__(self, words: list[tuple[bytes, int]], total: int, rare: np.ndarray | None = None,
                 rare_mean: np.ndarray | None = None):
        """Of the RARE tokens: ``rare``, their counts (default: equal shares of what the words leave of total),
        and ``rare_mean``, the mean log p(word | token) over their occurrences (default: 0)."""
        self.number = {w: i for i, (w, _) in enumerate(words)}
        self.words = pa.array([w for w, _ in words], pa.binary())
        count = np.zeros(VOCABULARY + RARE)
        count[:len(words)] = [n for _, n in words]
        count[VOCABULARY:] = max(0, total - sum(n for _, n in words)) / RARE if rare is None else rare
        count += 1  # no token is impossible
        before = np.cumsum(count) - count / 2
        self.class_of = np.minimum((CLASSES * before / count.sum()).astype(np.int64), CLASSES - 1)
        mass = np.bincount(self.class_of, weights=count, minlength=CLASSES)
        self.log_share = np.log(count / mass[self.class_of])
        self.prior = self.log_share.astype(np.float32)
        # a class is a range of tokens; neighbours of up to BLOCK tokens in all are multiplied as one block
        first = np.searchsorted(self.class_of, np.arange(CLASSES + 1))
        self.bounds = [0]
        for end, after in zip(first[1:], [*first[2:], PAD + BLOCK + 1]):
            if after - self.bounds[-1] > BLOCK and end > self.bounds[-1]:
                self.bounds.append(int(end))
        classes = [self.class_of[a:b] for a, b in zip(self.bounds, self.bounds[1:])]
        self.inside = [None if c[0] == c[-1] else c[:, None] == c for c in classes]
        self.word_mean = np.zeros(VOCABULARY + RARE)
        if rare_mean is not None:
            self.word_mean[VOCABULARY:] = rare_mean

    def by_block(self, ids: np.ndarray):
        """(first place, place after the last, first token, token after the last, tokens of the same class or None) of
        each block of the ascending ids."""
        ends = np.searchsorted(ids, self.bounds)
        for k in np.flatnonzero(ends[1:] > ends[:-1]):
            yield ends[k], ends[k + 1], self.bounds[k], self.bounds[k + 1], self.inside[k]

    def encode(self, words: list[bytes] | pa.Array) -> np.ndarray:
        return self.encoded(pa.array(words, pa.binary()))[0]

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Token numbers of the words; the places of those outside of the vocabulary, and these words."""
        ids = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        places = np.flatnonzero(ids < 0)
        rare = words.take(pa.array(places))
        ids[places] = [VOCABULARY + zlib.crc32(w) % RARE for w in rare.to_numpy(zero_copy_only=False)]
        return ids, places, rare


def fresh_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    scale = {"emb": 0.1, "inner": (2 * SIDE * WIDTH) ** -0.5, "outer": HIDDEN ** -0.5, "bias": 0, "out_bias": 0, "words": 0}
    return {n: (rng.standard_normal(shape) * scale[n]).astype(np.float32) for n, shape in _SHAPES}


def spread(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents laid end to end with SIDE times PAD before, between and after them, and each token's place there."""
    place = np.arange(SIDE, SIDE + len(ids)) + np.repeat(SIDE * np.arange(len(lengths)), lengths)
    laid = np.full(len(ids) + SIDE * (len(lengths) + 1), PAD, np.int64)
    laid[place] = ids
    return laid, place


_NEIGHBOURS = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def contexts(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(tokens, 2 * SIDE) neighbours of every token of documents laid end to end; PAD beyond their ends."""
    laid, place = spread(ids, lengths)
    return laid.take(place[:, None] + _NEIGHBOURS)


def _hidden(w, e: np.ndarray) -> np.ndarray:
    h = e.reshape(len(e), -1) @ w["inner"].reshape(-1, HIDDEN)
    h += w["bias"]
    return np.tanh(h, out=h)


def _classes(w, h: np.ndarray, steady: bool) -> np.ndarray:
    """Logits of the classes; steady: less their greatest."""
    z = h @ w["outer"]
    z += w["out_bias"]
    if steady:
        z -= z.max(axis=1, keepdims=True)
    return z


def _forward(w, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e = w["emb"].take(x, axis=0)
    h = _hidden(w, e)
    return e, h, _classes(w, h, True)


def _block(w, vocabulary: Vocabulary, h: np.ndarray, own: np.ndarray, a: int, b: int, inside, steady: bool) -> np.ndarray:
    """Logits of the tokens a to b; steady: less the greatest of the own token's class, the others' without a chance."""
    z = h @ w["words"][a:b].T
    z += vocabulary.prior[a:b]
    if steady:
        if inside is not None:
            z[~inside[own]] = -np.inf
        z -= z.max(axis=1, keepdims=True)
    return z


def _weigh(z: np.ndarray, own: np.ndarray | None = None, inside=None) -> np.ndarray:
    """exp in place, 0 outside of the own token's class; the sums."""
    np.exp(z, out=z)
    if inside is not None:
        z *= inside[own]
    return z @ np.ones(z.shape[1], z.dtype)


def calm_steps(w, vocabulary: Vocabulary) -> int:
    """Steps for which the exponentials of all logits are safe as they are. The hidden layer is from -1 to 1, which
    bounds them, and a step moves no weight by more than RATE."""
    words = np.abs(w["words"]).sum(axis=1) + np.abs(vocabulary.prior)
    classes = np.abs(w["outer"]).sum(axis=0) + np.abs(w["out_bias"])
    left = SAFE - max(words.max(), classes.max())
    return int(left / (RATE * (HIDDEN + 1))) + 1 if left > 0 else 0


def _added(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from each first to the next, two columns at a time (as complex numbers)."""
    pairs = rows.view(np.complex64 if rows.dtype == np.float32 else np.complex128)
    return np.add.reduceat(pairs, first).view(rows.dtype)


def _descend(weights: np.ndarray, squares: np.ndarray, d: np.ndarray) -> None:
    root = d * d
    squares += root
    np.sqrt(squares, out=root)
    d /= root
    d *= RATE
    weights -= d


def gradients(w, x: np.ndarray, y: np.ndarray, ids: np.ndarray | None = None, vocabulary: Vocabulary | None = None,
              steady: bool = True, squares=None) -> dict[str, np.ndarray]:
    """Of the mean loss of a minibatch; ``emb`` has one row a place of x. With the (ascending) token numbers ids,
    whose classes are y, the loss is that of the tokens, else that of the classes. With ``squares`` the weights of the
    tokens take their step here, block by block, and are not returned."""
    n = len(y)
    e = w["emb"].take(x, axis=0)
    h = _hidden(w, e)
    p = _classes(w, h, steady)
    p *= (1 / (n * _weigh(p)))[:, None]
    lines = np.arange(n)
    p[lines, y] -= 1 / n
    back = p @ w["outer"].T
    of_tokens = {}
    if ids is not None:
        if squares is None:
            of_tokens["words"] = np.zeros_like(w["words"])
        for i, j, a, b, inside in vocabulary.by_block(ids):
            own, here = ids[i:j] - a, h[i:j]
            q = _block(w, vocabulary, here, own, a, b, inside, steady)
            q *= (1 / (n * _weigh(q, own, inside)))[:, None]
            q[lines[:j - i], own] -= 1 / n
            back[i:j] += q @ w["words"][a:b]
            if squares is None:
                np.matmul(q.T, here, out=of_tokens["words"][a:b])
            else:
                _descend(w["words"][a:b], squares["words"][a:b], q.T @ here)
    back *= 1 - h * h
    return {**of_tokens, "outer": h.T @ p, "out_bias": p.sum(axis=0), "bias": back.sum(axis=0),
            "inner": (e.reshape(n, -1).T @ back).reshape(w["inner"].shape),
            "emb": (back @ w["inner"].reshape(-1, HIDDEN).T).reshape(-1, WIDTH)}


def learn(w, squares, x: np.ndarray, y: np.ndarray, ids: np.ndarray | None = None,
          vocabulary: Vocabulary | None = None, steady: bool = True) -> None:
    """One AdaGrad step, in place; ``squares`` are the sums of squared gradients so far."""
    g = gradients(w, x, y, ids, vocabulary, steady, squares)
    flat = x.ravel()
    order = flat.astype(np.uint16).argsort(kind="stable")
    rows = flat.take(order)
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    rows, d = rows[first], _added(g.pop("emb").take(order, axis=0), first)
    total = squares["emb"].take(rows, axis=0)
    total += d * d
    squares["emb"][rows] = total
    d /= np.sqrt(total, out=total)
    d *= RATE
    w["emb"][rows] -= d
    for name, d in g.items():
        _descend(w[name], squares[name], d)


def log_probabilities(w, vocabulary: Vocabulary, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log p(token | both sides) of every token of documents laid end to end; a rare token, whose word the
    number does not tell, with the mean log p(word | token)."""
    laid, place = spread(ids, lengths)
    out = np.empty(len(ids))
    position = [w["emb"] @ w["inner"][s] for s in range(2 * SIDE)]  # each token's part in the hidden layer
    steady = not calm_steps(w, vocabulary)
    for at in range(0, len(ids), BATCH):
        own, here = ids[at:at + BATCH], place[at:at + BATCH]
        order = np.argsort(own.astype(np.uint16), kind="stable")
        own, here = own[order], here[order]
        h = w["bias"] + position[0].take(laid.take(here + _NEIGHBOURS[0]), axis=0)
        for s in range(1, 2 * SIDE):
            h += position[s].take(laid.take(here + _NEIGHBOURS[s]), axis=0)
        np.tanh(h, out=h)
        z = _classes(w, h, steady)
        logs = z[np.arange(len(own)), vocabulary.class_of[own]]
        sums = _weigh(z)
        for i, j, a, b, inside in vocabulary.by_block(own):
            mine = own[i:j] - a
            z = _block(w, vocabulary, h[i:j], mine, a, b, inside, steady)
            logs[i:j] += z[np.arange(j - i), mine]
            sums[i:j] *= _weigh(z, mine, inside)
        logs -= np.log(sums)
        out[at + order] = logs
    return out + vocabulary.word_mean[ids]


def _join(texts, vocabulary) -> tuple[np.ndarray, np.ndarray]:
    words, lengths = words_of(pa.array(texts, pa.binary()))
    return vocabulary.encode(words), lengths


def _merged(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": table["word"], "n": table["n_sum"]})


def _count(batches):
    """(word, n) of the batches' texts; a word comes again when more than HELD of them had to be sent."""
    held, rows = [], 0
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            found = pc.value_counts(words_of(batch.column(0).slice(at, SLICE))[0])
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            rows += len(found)
            if rows > 2 * HELD:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > HELD:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if rows:
        yield from _merged(held).to_batches()


_CODED = {"n_tokens": "long", "ids": "binary", "rare": "array<binary>"}
_ARROW = pa.struct([("n_tokens", pa.int64()), ("ids", pa.binary()), ("rare", pa.list_(pa.binary()))])


def coded(vocabulary_of):
    """A UDF of texts (binary): ``n_tokens``, ``ids`` (the token numbers, 2 bytes each) and ``rare`` (the words outside of
    the vocabulary)."""
    def of(texts: pa.Array) -> pa.Array:
        vocabulary, parts = vocabulary_of.value, []
        for at in range(0, len(texts), SLICE):
            words, lengths = words_of(texts.slice(at, SLICE))
            ids, places, rare = vocabulary.encoded(words)
            cuts = np.concatenate(([0], np.cumsum(lengths)))
            ids = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((2 * cuts).astype(np.int32)),
                                                                    pa.py_buffer(ids.astype("<u2"))])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(places, cuts).astype(np.int32)), rare)
            parts.append(pa.StructArray.from_arrays([pa.array(lengths), ids, rare], list(_CODED)))
        return pa.concat_arrays(parts) if parts else pa.array([], _ARROW)

    return F.arrow_udf(of, ", ".join(f"{name} {kind}" for name, kind in _CODED.items()))


def _laid(ids) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and lengths of the documents of coded ids, end to end."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
    return np.frombuffer(b"".join(ids), "<u2").astype(np.int64), lengths


def _vocabulary_and_rare(texts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and (word, share) of every other word: what its log p(word | token) is beyond the token's
    mean, in units of 1 / UNIT."""
    counts = landed(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm_words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # landed first: a collected limit would send every task's share of it to the driver
    top = landed(counts.where(F.col("n") >= MIN_SHARE * total).orderBy(F.desc("n"), "word").limit(VOCABULARY), "lm_top")
    words = sorted(((bytes(r["word"]), r["n"]) for r in top.collect()), key=lambda r: (-r[1], r[0]))
    rest = (counts.join(F.broadcast(top.select("word")), "word", "left_anti")
            .withColumn("token", F.pmod(F.crc32("word"), F.lit(RARE)).cast("int")))
    mass, mean = np.zeros(RARE), np.zeros(RARE)
    for r in rest.groupBy("token").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("n_log_n")).collect():
        mass[r["token"]] = r["n"]
        mean[r["token"]] = r["n_log_n"] / r["n"] - np.log(r["n"] + 1)

    def of(values):
        return F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("token"))

    beyond = F.log("n") - of(np.log(mass + 1)) - of(mean)
    return Vocabulary(words, total, mass, mean), rest.select("word", F.round(beyond * UNIT).cast("long").alias("share"))


def build_vocabulary(texts: DataFrame) -> Vocabulary:
    """From the column ``text`` (binary), over all rows."""
    return _vocabulary_and_rare(texts)[0]


def _flatten(w) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n, _ in _SHAPES])


def _unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES:
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape).copy()
        at += size
    return out


def walk(w, squares, ids: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary, round_: int, rng) -> int:
    """Learn from the round's positions of documents laid end to end, in disorder; their number."""
    pick = np.arange(round_, len(ids), ROUNDS)
    rng.shuffle(pick)
    laid, place = spread(ids, lengths)
    calm = 0
    for i in range(0, len(pick), MINIBATCH):
        calm = calm - 1 if calm > 1 else calm_steps(w, vocabulary)
        at = pick[i:i + MINIBATCH]
        own = ids[at]
        order = own.astype(np.uint16).argsort(kind="stable")
        at, own = at[order], own[order]
        learn(w, squares, laid.take(place[at][:, None] + _NEIGHBOURS), vocabulary.class_of[own], own, vocabulary,
              not calm)
    return len(pick)


def average(frame: pd.DataFrame) -> pd.DataFrame:
    """One row of several of a slice: the weights' mean by positions seen, in order of the tasks."""
    frame = frame.sort_values("task")
    total, mean = int(frame["seen"].sum()), 0
    for seen, raw in zip(frame["seen"], frame["weights"]):
        mean = mean + np.frombuffer(raw, np.float32).astype(float) * (seen / total)
    return pd.DataFrame({"slice": [int(frame["slice"].iloc[0])], "task": [int(frame["task"].iloc[0])], "seen": [total],
                         "weights": [mean.astype(np.float32).tobytes()]})


def train(texts: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after ROUNDS of local descent and averaging over all rows of column ``text`` (binary)."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    return _train(texts.select(coded(shared)("text").alias("c")).select("c.ids"), shared)


def _train(codes: DataFrame, shared_vocabulary) -> dict[str, np.ndarray]:
    """``train`` on the column ``ids`` of ``coded`` texts."""
    sc = codes.sparkSession.sparkContext
    w = fresh_weights()
    for round_ in range(ROUNDS):
        shared = sc.broadcast(_flatten(w))

        def descend(frames):
            from pyspark import TaskContext

            own, seen, task = _unflatten(shared.value), 0, TaskContext.get().partitionId()
            squares = {name: np.full_like(a, 1e-6) for name, a in own.items()}
            for frame in frames:
                for at in range(0, len(frame), SLICE):
                    ids, lengths = _laid(frame["ids"][at:at + SLICE])
                    rng = np.random.default_rng([SEED, round_, task, at])
                    seen += walk(own, squares, ids, lengths, shared_vocabulary.value, round_, rng)
            if seen:
                parts = np.array_split(_flatten(own), SLICES)
                yield pd.DataFrame({"slice": range(SLICES), "task": task, "seen": seen, "weights": [p.tobytes() for p in parts]})

        sums = landed(codes.mapInPandas(descend, "slice int, task int, seen long, weights binary"), "lm_weights")
        while True:  # FAN_IN tasks at a time, so that no group grows with the number of tasks
            tasks = sums.agg(F.max("task")).first()[0]
            sums = (sums.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("slice", "task")
                    .applyInPandas(average, "slice int, task int, seen long, weights binary"))
            if tasks is None or tasks < FAN_IN:
                break
            sums = landed(sums, "lm_weights")
        rows = sums.collect()
        if rows:
            w = _unflatten(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["slice"])]))
    return w


def score(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with ``n_tokens``, ``log_prob`` (sum of log p over its tokens) and ``mean_log_prob``.

    The vocabulary and the network are learned from all rows of docs. Null or empty text: no tokens,
    log_prob 0, mean null. Repeated rows: each counts and is scored. Empty table: no rows. Texts are scored
    whole.
    """
    sc = docs.sparkSession.sparkContext
    ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    vocabulary, rare = _vocabulary_and_rare(texts)
    shared_vocabulary = sc.broadcast(vocabulary)
    codes = landed(docs.select(packed(docs, carry), coded(shared_vocabulary)(F.col(text_col).cast("binary")).alias("c")).select(
        "__in", F.monotonically_increasing_id().alias("row"), "c.n_tokens", "c.ids", "c.rare"), "lm_coded")
    shared = sc.broadcast(_train(codes.select("ids"), shared_vocabulary))

    def scored(column: pd.Series) -> pd.Series:
        sums = []
        for at in range(0, len(column), SLICE):
            ids, lengths = _laid(column.iloc[at:at + SLICE])
            ends = np.cumsum(np.concatenate(([0.0], log_probabilities(shared.value, shared_vocabulary.value, ids, lengths))))
            cuts = np.concatenate(([0], np.cumsum(lengths)))
            sums.append(ends[cuts[1:]] - ends[cuts[:-1]])
        return pd.Series(np.concatenate(sums) if sums else np.zeros(0))

    done = codes.select("__in", "row", "n_tokens", F.pandas_udf(scored, "double")("ids").alias("log_prob"))
    shares = (codes.select("row", F.explode("rare").alias("word")).join(rare, "word")
              .groupBy("row").agg(F.sum("share").alias("share")))
    log_prob = F.col("log_prob") + F.coalesce(F.col("share"), F.lit(0)) / F.lit(float(UNIT))
    done = done.join(shares, "row", "left").withColumn("log_prob", log_prob)
    return unpacked(done.select("__in", "n_tokens", "log_prob", (F.col("log_prob") / F.nullif(F.col("n_tokens"), F.lit(0)))
                                .alias("mean_log_prob")), ["n_tokens", "log_prob", "mean_log_prob"])
