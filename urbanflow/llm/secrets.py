"""Secret scans: fixed patterns, then a battery of randomness tests over every long token.

Tokens (runs of ``[A-Za-z0-9+/_=-]``, 16 or more) get the smallest encoding whose alphabet holds them
(decimal, hexadecimal, base32, base36, alphabetic, base62, base64). A token of n characters passes the
battery if none of these rejects that it was drawn evenly from that alphabet: chi-squared over the
symbols, the runs test above and below the alphabet's middle, and the lag-1 serial correlation.

Passing is easy for a short token, so what passes needs evidence against the other hypothesis, ordinary
structured text: few repeated symbols for the length (symbol pairs that are equal, against the rate of
text) and many changes between letters and digits (against the rate of text; signs, which part the
words of paths, names and dates, belong to what stands before them). Both tails have
closed bounds whose strength grows with the length; their product gives a p-value (Fisher). Over all
tokens of the corpus, within each class of length, the Benjamini-Hochberg step-up keeps the false
discovery rate at ``FDR``. Its thresholds come from counts on a fixed grid of p-values, summed over
all documents; no token reaches the driver.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed, packed, ship, unpacked

KINDS = ("assign", "access", "hex", "random")
# fixed values: the base patterns
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

_AZ, _az, _09 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: name, alphabet, in order of size; the first that holds a token is its encoding
ENCODINGS = (("decimal", _09), ("hex", _09 + "abcdef"), ("HEX", _09 + "ABCDEF"), ("lower", _az), ("upper", _AZ),
             ("base32", _AZ + "234567"), ("base36", _09 + _az), ("BASE36", _09 + _AZ), ("alpha", _AZ + _az),
             ("base62", _09 + _AZ + _az), ("base64", _AZ + _az + _09 + "+/_-="))
#: level of each randomness test
ALPHA = 1e-3
FDR = 0.01
#: rate of equal symbol pairs and of changes between letters and digits in ordinary text
TEXT_PAIRS, TEXT_CHANGES = 0.065, 0.08
#: first lengths of the classes
LENGTHS = (16, 20, 24, 32, 48, 64, 128)
#: p-values are compared on this grid of -ln p
GRID, CELLS = 0.1, 2000

_DIGIT, _SIGN = np.zeros(128, bool), np.zeros(128, bool)
_DIGIT[[ord(c) for c in _09]] = True
_SIGN[[ord(c) for c in "+/_=-"]] = True
_PLACE = np.full((len(ENCODINGS), 128), -1, np.int16)
for _e, (_, _alphabet) in enumerate(ENCODINGS):
    _PLACE[_e, [ord(c) for c in _alphabet]] = np.arange(len(_alphabet))
_SIZE = np.array([len(a) for _, a in ENCODINGS], float)
_erfc = np.frompyfunc(math.erfc, 1, 1)


def _two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2)).astype(float)


def battery(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(passes, evidence) of ASCII tokens: whether no test rejects randomness, and -ln p against text."""
    m = len(tokens)
    if not m:
        return np.zeros(0, bool), np.zeros(0)
    n = np.array([len(t) for t in tokens])
    flat = np.frombuffer(b"".join(tokens), np.uint8)
    of, start = np.repeat(np.arange(m), n), np.concatenate(([0], np.cumsum(n)[:-1]))
    counts = np.bincount(of * 128 + flat, minlength=m * 128).reshape(m, 128)
    fits = np.stack([~counts[:, _PLACE[e] < 0].any(axis=1) for e in range(len(ENCODINGS))], axis=1)
    enc = fits.argmax(axis=1)
    k = _SIZE[enc]
    # chi-squared over the symbols, to a normal deviate by Wilson and Hilferty; padding counts as a symbol
    chi = (counts.astype(float) ** 2).sum(axis=1) * k / n - n
    df = k - 1
    z_chi = (np.cbrt(chi / df) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))
    p_chi = _erfc(z_chi / math.sqrt(2)).astype(float) / 2
    place = _PLACE[enc[of], flat].astype(float)
    high = place >= (k / 2)[of]
    same = of[1:] == of[:-1]
    inner = of[1:][same]
    # runs above and below the middle of the alphabet
    n1 = np.bincount(of, weights=high, minlength=m)
    n2 = n - n1
    runs = 1 + np.bincount(inner, weights=(high[1:] != high[:-1])[same], minlength=m)
    mean = 1 + 2 * n1 * n2 / n
    var = np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9)
    p_runs = np.where((n1 == 0) | (n2 == 0), 2.0 ** (1 - np.minimum(n, 1000)), _two_sided((runs - mean) / np.sqrt(var)))
    # lag-1 serial correlation
    centred = place - (np.add.reduceat(place, start) / n)[of]
    power = np.add.reduceat(centred ** 2, start)
    lag = np.bincount(inner, weights=(centred[1:] * centred[:-1])[same], minlength=m)
    p_lag = np.where(power > 0, _two_sided((lag / np.maximum(power, 1e-9) + 1 / n) * np.sqrt(n)), 0.0)
    passes = (p_chi >= ALPHA) & (p_runs >= ALPHA) & (p_lag >= ALPHA)
    # evidence against text: Poisson lower tail of equal pairs, binomial upper tail of class changes
    pairs = (counts.astype(float) * (counts - 1)).sum(axis=1) / 2
    rate = TEXT_PAIRS * n * (n - 1) / 2
    few = np.where(pairs < rate, rate - pairs + pairs * np.log(np.maximum(pairs, 1e-300) / rate), 0.0)
    sign = _SIGN[flat]
    sign[start] = False
    kind = _DIGIT[flat][np.maximum.accumulate(np.where(sign, 0, np.arange(len(flat))))]
    changes = np.bincount(inner, weights=(kind[1:] != kind[:-1])[same], minlength=m)
    q = changes / (n - 1)
    kl = (q * np.log(np.maximum(q, 1e-300) / TEXT_CHANGES)
          + (1 - q) * np.log(np.maximum(1 - q, 1e-300) / (1 - TEXT_CHANGES)))
    many = np.where(q > TEXT_CHANGES, (n - 1) * kl, 0.0)
    both = few + many
    return passes, np.maximum(both - np.log1p(both), 0.0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, end exclusive, by start and then kind as listed."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= 12:
            found.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            found.append((m.start(), 1, m.end()))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end()))
    return [(i, j, KINDS[k]) for i, k, j in sorted(found)]


def uncovered(start: int, end: int, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """What is left of [start, end) beside the spans (sorted by start), in parts of the least length of a token."""
    out, at = [], start
    for i, j, _ in spans:
        if j > at and i < end:
            if i - at >= LENGTHS[0]:
                out.append((at, i))
            at = max(at, j)
    if end - at >= LENGTHS[0]:
        out.append((at, end))
    return out


def _scan(texts: pd.Series) -> pd.DataFrame:
    base, tokens, where = [], [], []
    for row, text in enumerate(texts):
        text = text or ""
        spans = base_spans(text)
        base.append([{"kind": k, "start": i, "end": j} for i, j, k in spans])
        for m in TOKEN.finditer(text):
            for i, j in uncovered(m.start(), m.end(), spans) if spans else [m.span()]:
                tokens.append(text[i:j].encode())
                where.append((row, i, j))
    tried: list[list[dict]] = [[] for _ in base]
    passes, evidence = battery(tokens)
    bins = np.searchsorted(LENGTHS, [len(t) for t in tokens], side="right") - 1
    cells = np.where(passes, np.minimum((evidence / GRID).astype(int), CELLS), 0)
    for (row, i, j), b, c in zip(where, bins.tolist(), cells.tolist()):
        tried[row].append({"start": i, "end": j, "len_class": b, "cell": c})
    return pd.DataFrame({"base": base, "tried": tried})


_SCANNED = ("base array<struct<kind string, start int, `end` int>>, "
            "tried array<struct<start int, `end` int, len_class int, cell int>>")


def step_up(counts: dict[int, int], fdr: float = FDR) -> int:
    """Least grid cell that Benjamini-Hochberg lets pass, from {cell: tokens} of one class of length (cell 0:
    p-value 1); past the grid if none does. A cell's p-value is that of its lower edge."""
    tests, run, least = sum(counts.values()), 0, CELLS + 1
    for cell in sorted(counts, reverse=True):
        run += counts[cell]
        if cell and math.exp(-cell * GRID) <= fdr * run / tests:
            least = cell
    return least


def secrets(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, fdr: float = FDR) -> DataFrame:
    """Every row of docs with ``spans``: array of (kind, start, end), by start, then kind as in KINDS.

    Null or empty text: no spans. Kinds are found independently, so spans of several base kinds may overlap; of a
    token that a base span touches, the parts beside it (16 characters or more) are tested and reported as random. Repeated rows: each is scanned, and each
    counts as tests. Empty table: no rows. Texts may be of any length; positions are code points.
    """
    ship(docs.sparkSession)
    scanned = landed(docs.select(packed(docs, carry), F.pandas_udf(_scan, _SCANNED)(F.col(text_col)).alias("scan"))
                     .select("__in", "scan.base", "scan.tried"), "secrets")
    counts = (scanned.select(F.explode("tried").alias("t")).groupBy("t.len_class", "t.cell").count()
              .collect())  # at most classes x grid cells
    by_length: dict[int, dict[int, int]] = {}
    for r in counts:
        by_length.setdefault(r["len_class"], {})[r["cell"]] = r["count"]
    least = F.array(*[F.lit(step_up(by_length.get(b, {}), fdr)) for b in range(len(LENGTHS))])

    def hit(t):
        return t["cell"] >= F.get(least, t["len_class"])

    added = F.transform(F.filter("tried", hit), lambda t: F.struct(F.lit("random").alias("kind"), t["start"], t["end"]))
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    spans = F.transform(F.array_sort(F.transform(F.concat("base", added), lambda s: F.struct(
        s["start"], order[s["kind"]].alias("at"), s["kind"], s["end"]))), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return unpacked(scanned.select("__in", spans.alias("spans")), ["spans"])
