"""Language identification by a linear-chain conditional random field over words.

Words are runs of letters, lower-cased. Each has affix, n-gram and lexicon features (hashed); their
weights and the transitions between languages are learned together, by gradient ascent on the
conditional likelihood in numpy. Forward-backward gives each word of a text its language
probabilities in the light of the whole text, so code-switched passages are labelled word by word; a
document's language is the one with most expected words, its score their share.

Fit: up to ``PER_LANGUAGE`` labelled documents of each language (the documented bound; drawn by lot from
their ids; of a longer one, ``FIT_CHARS`` characters from a place that its id gives), cut into spans that are strung together
across documents and languages, so that the transitions learn switches. Everything else covers all
texts whole. Prediction is map-only: the model is broadcast (its size depends on the features and
languages alone), texts never move.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOTS, lot, packed, ship, unpacked

FEATURES = 1 << 16
PER_LANGUAGE = 300
FIT_CHARS = 20_000
LEXICON = 300
#: words of a training chain, and the chance that a span ends after a word
CHAIN, SWITCH = 64, 0.04
STEPS, RATE, PENALTY = 60, 0.3, 1e-4
#: words that a task keeps the scores of, words of one forward-backward batch, words scored at once
CACHE, BATCH, SCORED = 200_000, 200_000, 20_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(word: str, lexicons: list[frozenset]) -> list[int]:
    """Prefixes and suffixes up to 3, inner 2- and 3-grams with word ends, the lexicons that hold the word."""
    crc, w = zlib.crc32, f"^{word}$"
    out = [crc(f"p{word[:k]}".encode()) for k in (1, 2, 3)] + [crc(f"s{word[-k:]}".encode()) for k in (1, 2, 3)]
    out += [crc(w[i:i + 2].encode()) for i in range(len(w) - 1)]
    out += [crc(w[i:i + 3].encode()) for i in range(len(w) - 2)]
    return [h % FEATURES for h in out] + [FEATURES + i for i, lex in enumerate(lexicons) if word in lex]


def _flat(all_words, lexicons) -> tuple[np.ndarray, np.ndarray]:
    lists = [features(w, lexicons) for w in all_words]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((f for one in lists for f in one), np.int64, int(sizes.sum())), sizes


class Model:
    """Languages, feature weights (features x languages), start and transition log-weights."""

    def __init__(self, languages, lexicons, weights, start, trans):
        self.languages, self.lexicons = list(languages), lexicons
        self.weights, self.start, self.trans = weights, start, trans

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        """Log-weights of each word (mean over its features, times a learned scale within the weights)."""
        if not vocabulary:
            return np.zeros((0, len(self.languages)), np.float32)
        flat, sizes = _flat(vocabulary, self.lexicons)
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return (np.add.reduceat(self.weights[flat], at) / np.sqrt(sizes)[:, None]).astype(np.float32)


def forward_backward(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray,
                     pairs: bool = False):
    """Marginals (words x languages) of chains laid end to end; with ``pairs`` also the expected transition
    counts. Chains go longest first, so that each step works on the chains that are still running."""
    n, k = emit.shape
    order = np.argsort(-lengths, kind="stable")
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
    running = lengths[order]
    steps = int(running[0]) if len(running) else 0
    active = np.searchsorted(-running, -np.arange(steps), side="left")  # chains longer than t
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    t_mat, s_vec = np.exp(trans - trans.max()).astype(e.dtype), np.exp(start - start.max()).astype(e.dtype)
    alpha = np.empty_like(e)
    a = None
    for t in range(steps):
        at = begin[:active[t]] + t
        a = (s_vec * e[at]) if t == 0 else (a[:active[t]] @ t_mat) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    gamma = np.empty_like(e)
    expected = np.zeros((k, k))
    beta = np.ones((active[0] if steps else 0, k), e.dtype)
    for t in range(steps - 1, -1, -1):
        at = begin[:active[t]] + t
        more = active[t + 1] if t + 1 < steps else 0
        if more:
            ahead = e[begin[:more] + t + 1] * beta[:more]
            if pairs:
                joint = alpha[at[:more]][:, :, None] * t_mat * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = ahead @ t_mat.T
            beta[:more] = back / back.sum(axis=1, keepdims=True)
        g = alpha[at] * beta[:active[t]]
        gamma[at] = g / g.sum(axis=1, keepdims=True)
    return (gamma, expected) if pairs else gamma


def _chains(docs: list[tuple[list[str], int]], rng) -> list[tuple[str, int]]:
    """Words with labels: spans of the documents in turn, dealt at random."""
    spans = []
    for ws, y in docs:
        at = 0
        while at < len(ws):
            n = int(rng.geometric(SWITCH))
            spans.append((ws[at:at + n], y))
            at += n
    rng.shuffle(spans)
    return [(w, y) for ws, y in spans for w in ws]


def fit(rows: list[tuple[str, str]], seed: int = 42) -> Model | None:
    """Model from (text, language) rows; None if there is no language."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    docs = [(words(t), number[lang]) for t, lang in rows]
    counts = [Counter() for _ in languages]
    for ws, y in docs:
        counts[y].update(ws)
    total = Counter()
    for c in counts:
        total.update(c)
    lexicons = [frozenset(sorted((w for w in c if 2 * c[w] > total[w]), key=lambda w: (-c[w], w))[:LEXICON]) for c in counts]
    rng = np.random.default_rng(seed)
    chain = _chains(docs, rng)
    k = len(languages)
    if not chain:
        return Model(languages, lexicons, np.zeros((FEATURES + k, k), np.float32), np.zeros(k), np.zeros((k, k)))
    vocabulary = {}
    ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w, _ in chain])
    y = np.array([label for _, label in chain])
    flat, sizes = _flat(vocabulary, lexicons)
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    scale = 1 / np.sqrt(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = len(ids)
    lengths = np.full(-(-n // CHAIN), CHAIN)
    lengths[-1] = n - CHAIN * (len(lengths) - 1)
    inside = np.ones(n, bool)
    inside[::CHAIN] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:-1][inside[1:]], y[1:][inside[1:]]), 1)
    w, trans, start = np.zeros((FEATURES + k, k)), np.zeros((k, k)), np.zeros(k)
    gw, gt = np.full_like(w, 1e-8), np.full_like(trans, 1e-8)
    truth = np.zeros((len(sizes), k))
    np.add.at(truth, (ids, y), 1)
    for _ in range(STEPS):  # AdaGrad on the mean log-likelihood
        emit = (np.add.reduceat(w[flat], at) * scale[:, None])[ids]
        gamma, expected = forward_backward(emit, lengths, start, trans, pairs=True)
        guess = np.stack([np.bincount(ids, weights=gamma[:, j], minlength=len(sizes)) for j in range(k)], axis=1)
        word_grad = (truth - guess) * scale[:, None] / n
        grad = np.stack([np.bincount(flat, weights=word_grad[owner, j], minlength=len(w)) for j in range(k)], axis=1)
        grad -= PENALTY * w / len(w) * k
        t_grad = (seen - expected) / n - PENALTY * trans
        gw += grad ** 2
        gt += t_grad ** 2
        w += RATE * grad / np.sqrt(gw)
        trans += RATE * t_grad / np.sqrt(gt)
    return Model(languages, lexicons, w.astype(np.float32), start, trans)


class Scores:
    """Emissions of words under a model, kept in two generations: when the young one is half of CACHE it becomes
    the old one, and words of the former old one that are not asked for again go."""

    def __init__(self, model: Model):
        self.model = model
        self.old, self.young = self._empty(), self._empty()

    def _empty(self) -> tuple[dict[str, int], np.ndarray]:
        return {}, np.zeros((0, len(self.model.languages)), np.float32)

    def of(self, distinct: list[str]) -> np.ndarray:
        """A row of each word."""
        out = np.empty((len(distinct), len(self.model.languages)), np.float32)
        for i in range(2):
            rows, matrix = (self.young, self.old)[i]
            at = np.fromiter((rows.get(w, -1) for w in distinct), np.int64, len(distinct))
            if i == 0:
                young = at >= 0
                out[young] = matrix[at[young]]
            else:
                old = (at >= 0) & ~young
                out[old] = matrix[at[old]]
        new = np.flatnonzero(~young & ~old)
        for part in np.split(new, list(range(SCORED, len(new), SCORED))):
            out[part] = self.model.emissions([distinct[i] for i in part])
        fresh = np.flatnonzero(~young)
        if len(self.young[0]) + len(fresh) > CACHE // 2:
            self.old, self.young = self.young, self._empty()
        if len(fresh) <= CACHE // 2:
            rows, matrix = self.young
            rows.update(zip((distinct[i] for i in fresh), range(len(rows), len(rows) + len(fresh))))
            self.young = rows, np.concatenate((matrix, out[fresh]))
        return out


def label(texts: list[str | None], model: Model, scores: Scores | None = None):
    """(position, language probabilities of each word) of every text. Texts come in order of length, so that
    those of a batch run together for most of their steps; no more than a batch's words are held. ``scores``
    carries word scores from call to call."""
    scores = scores or Scores(model)

    def batch(at: list[int], held: list[list[str]]):
        place: dict[str, int] = {}
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        ids = np.fromiter((place.setdefault(w, len(place)) for ws in held for w in ws), np.int64, int(lengths.sum()))
        gamma = forward_backward(scores.of(list(place))[ids], lengths[lengths > 0], model.start, model.trans)
        yield from zip(at, np.split(gamma, np.cumsum(lengths)[:-1]))

    at, held, total = [], [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i] or "")):
        at.append(i)
        held.append(words(texts[i]))
        total += len(held[-1])
        if total > BATCH:
            yield from batch(at, held)
            at, held, total = [], [], 0
    if held:
        yield from batch(at, held)


def drawn_rows(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """text, lang, id of the labelled documents that the fit takes: at most PER_LANGUAGE ids of each language."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).alias("text"))
    small = rows.where("lang is not null and id is not null and text is not null")
    places = F.greatest(F.length("text") - F.lit(FIT_CHARS), F.lit(0)) + 1
    at = F.pmod(F.xxhash64(F.lit(6), "id"), places).cast("int") + 1
    spans = small.withColumn("text", F.substring("text", at, F.lit(FIT_CHARS)))
    # a share of each language that holds several times what is wanted, so that no task ranks more than that
    share = small.groupBy("lang").agg(
        F.least(F.lit(1.0), F.lit(4.0 * PER_LANGUAGE) / F.count("*")).alias("share"))
    rank = Window.partitionBy("lang").orderBy("lot", "id")
    # one row a language: a hint, so that the filter runs where the rows are read
    drawn = (small.select("lang", "id", lot(5, "id").alias("lot")).join(F.broadcast(share), "lang")
             .where(F.col("lot") < F.col("share") * LOTS).groupBy("lang", "id").agg(F.first("lot").alias("lot")))
    chosen = (drawn.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= PER_LANGUAGE).select("lang", "id"))
    # an id that repeats sends one span, the least of its texts
    return (spans.join(F.broadcast(chosen), ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))
            .select("text", "lang", "id"))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Model from a bounded sample of labelled rows (see the module's head); null ids, texts and languages
    are left out."""
    sample = drawn_rows(labelled, id_col, text_col, lang_col).collect()
    return fit([(r["text"], r["lang"]) for r in sorted(sample, key=lambda r: (r["lang"], r["id"], r["text"]))])


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with ``lang_pred`` and ``score`` (0 to 1).

    Null or empty text, or one without a letter: ``und``, score 0; so is every text without a model. Equal
    texts get equal results, repeated rows each their own. Empty table: no rows. Ties: the first language
    by name.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        kept = Scores(m) if m else None  # as long as the partition
        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for i, gamma in (label(texts.tolist(), m, kept) if m else ()):
                if len(gamma):
                    share = gamma.sum(axis=0, dtype=float) / len(gamma)
                    best = int(share.argmax())
                    names[i], scores[i] = m.languages[best], min(1.0, float(share[best]))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    done = docs.select(packed(docs, carry), F.pandas_udf(predict, "lang_pred string, score double")(
        F.col(text_col)).alias("p"))
    return unpacked(done.select("__in", "p.lang_pred", "p.score"), ["lang_pred", "score"])


def held_out(id_col):
    """Rows whose language is never learned from (a null id: false; such rows are not learned from either)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
