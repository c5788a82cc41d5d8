"""Packing: an exact round trip through the tokenizer, window rules, leftovers over several rounds."""

import zlib

import numpy as np
import pytest

from fixtures import messy, read, texts
from urbanflow.llm import bpe, packing
from urbanflow.llm.queries import op4_packing, tokenizer_path

ODD = ["Ａｂｃ don't I'LL naïve É é ΣΑΣ İstanbul a\x1cb c\x1fd <|endoftext|> x<|startoftext|>y ①²3 ﬁx ß ŉa", "", None,
       "...!!! a.b,c 'S 12ab Ǆ ǆ ſs K İx é ́a", "日本語 текст ελληνικά  z"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, want, length=packing.LENGTH):
    """rows: pieces; want: {id: ids}. Every id once, windows gapless; returns the share of padding."""
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = want[i][at:at + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(want[i])
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(want[i])
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return 1 - sum(map(len, want.values())) / (len(by_window) * length)


def test_query_is_an_exact_round_trip(spark, tokenizer):
    want = {i: ids_of(tokenizer, t) for i, t in texts(spark).items()}
    assert check(op4_packing(spark, "/root/testdata/sf0.001").collect(), want) < 0.02


def test_words_give_the_tokenizers_ids(tokenizer):
    encoder = packing.Encoder(tokenizer_path())
    assert encoder.batch(ODD) == [ids_of(tokenizer, t).tobytes() for t in ODD]
    assert encoder.batch(ODD) == [ids_of(tokenizer, t).tobytes() for t in ODD]  # from the cache


def test_leftovers_merge_over_several_rounds(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    monkeypatch.setattr(packing, "OPEN", 3)
    docs = read(spark, "documents").repartition(9)
    want = {i: ids_of(tokenizer, t) for i, t in texts(spark).items()}
    padding = check(packing.pack(docs, tokenizer_path(), length=512).collect(), want, 512)
    assert padding < 0.05


def test_slices_of_a_few_words(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 9)
    encoder = packing.Encoder(tokenizer_path())
    many = ["one two three. four", None, "five six, seven", "", "one two three.", "x" * 40]
    for texts_ in ([many[0]], many[2:3], many, []):
        assert encoder.batch(texts_) == [ids_of(tokenizer, t).tobytes() for t in texts_]


def test_best_fit():
    p = packing.Packer(10, 2)
    assert p.place(6, "a") and p.place(5, "b") and p.place(4, "c")  # c fits the first window best
    assert p.windows == [["a", "c"], ["b"]] and p.room == [0, 5]
    assert not p.place(6, "d") and p.fullest() == 0 and p.out(0) == ["a", "c"] and p.place(6, "d")


def test_edges(spark, tokenizer):
    docs = messy(spark)
    rows = packing.pack(docs, tokenizer_path()).collect()
    want: dict = {}
    for r in docs.collect():
        want.setdefault(r["doc_id"], []).append(ids_of(tokenizer, r["text"]))
    for i, copies in want.items():
        mine = [r for r in rows if r["doc_id"] == i]
        assert sum(r["length"] for r in mine) == sum(map(len, copies))
        assert all(r["doc_tokens"] == len(copies[0]) for r in mine)
    assert [(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] in (2, 3)] == [(1, zlib.crc32(b"\1\0\0\0"))] * 2
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0
