import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from formline.llm import packing as K
from formline.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, piece string, row int"


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéßñ'1-.!") for _ in range(rng.randrange(1, 12)))
    rows = [" ".join(word() for _ in range(rng.choice([0, 1, 5, 80, 900, 3000]))) for _ in range(60)]
    rows += [None, "", "  \n ", "İİ KK Å Å", "a b c\u0085d\x1ce", "<|endoftext|> x", "don't we'll", "日本語 テスト", "x" * 30_000]
    return rows + rows[:5]


def test_ids_are_those_of_the_whole_text(spark):
    path = tokenizer_file(K.TOKENIZER)
    words = K.WordTokens(path)
    plain = words.tokenizer
    for text in texts():
        want = plain.encode(text or "", add_special_tokens=False).ids
        assert encoded(words, [text]) == [want]
    every = [t or "" for t in texts()]
    assert encoded(words, every) == [plain.encode(t, add_special_tokens=False).ids for t in every]


def test_a_very_long_text(monkeypatch):
    monkeypatch.setattr(K, "SLICE_BYTES", 1_000)
    monkeypatch.setattr("formline.llm.texts.chunks.__defaults__", (1_000,))
    words = K.WordTokens(tokenizer_file(K.TOKENIZER))
    for text in ("été don't stop 12 " * 3_000, "x" * 50_000, " " * 9_000, "a" * 5_000 + " " + "b" * 5_000):
        assert encoded(words, [text]) == [words.tokenizer.encode(text, add_special_tokens=False).ids]


def encoded(words, rows):
    raw = [(t or "").encode() for t in rows]
    ids, at = words.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)], dtype=np.int64))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAeE éÉñßàÀ×÷Ÿÿµªº'.,!*&%0123 \n\u0301\u0323\u0130ΣςKÅ²½"))), max_size=6))
def test_any_texts(rows):
    words = K.word_tokens(tokenizer_file(K.TOKENIZER))
    assert encoded(words, rows) == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in rows]


def test_small_word_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(K, "CACHE_IDS", 500)
    words, plain = K.WordTokens(tokenizer_file(K.TOKENIZER)), K.WordTokens(tokenizer_file(K.TOKENIZER)).tokenizer
    for text in texts():
        assert encoded(words, [text]) == [plain.encode(text or "", add_special_tokens=False).ids]


@pytest.mark.parametrize("group", [10, 20_000])
def test_documents_round_trip(spark, group):
    rows = [(i % 50, t, "clash", 7) for i, t in enumerate(texts())]
    packed = K.pack_documents(spark.createDataFrame(rows, SCHEMA), tokenizer_file(K.TOKENIZER), with_ids=True, group_pieces=group).toPandas()
    plain = K.WordTokens(tokenizer_file(K.TOKENIZER)).tokenizer
    want = sorted((i, tuple(plain.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, _, _ in rows)
    got = []
    for _, part in packed.groupby("row"):
        part = part.sort_values("piece")
        assert part["piece"].tolist() == list(range(len(part)))
        assert part["start"].tolist() == [4096 * k for k in range(len(part))] and (part["length"].iloc[:-1] == 4096).all()
        got.append((part["doc_id"].iloc[0], tuple(np.concatenate(part["ids"].to_list()).tolist())))
    assert sorted(got) == want
    for _, part in packed.groupby("sequence_id"):
        part = part.sort_values("offset")
        ends = part["length"].cumsum()
        assert (part["offset"] == ends - part["length"]).all() and ends.iloc[-1] <= 4096
    assert (packed["ids_crc32"] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in packed["ids"]]).all()
    least = K.lower_bound(packed["length"].to_numpy())
    assert least <= packed["sequence_id"].nunique() <= least + (1 if group > 10 else 10)


def test_exchange_fills_the_gaps_of_partitions(spark):
    rng = random.Random(2)
    rows = [(i, 0, rng.choice([1400, 1500, 2000, 2100, 2700, 700, 4096])) for i in range(2_000)]
    pieces = spark.createDataFrame(rows, "row long, piece int, length long")
    once = K.pack(pieces, group_pieces=40, rounds=0).select("sequence_id").distinct().count()
    packed = K.pack(pieces, group_pieces=40).toPandas()
    assert len(packed) == 2_000 and packed.groupby("sequence_id")["length"].sum().max() <= 4096
    assert packed["sequence_id"].nunique() < once
    assert (packed["bins"] >= packed["bound"]).all()


def test_empty_table(spark):
    assert K.pack_documents(spark.createDataFrame([], SCHEMA), tokenizer_file(K.TOKENIZER)).count() == 0


def best_packing(lengths, capacity):
    """The fewest bins, by trying everything."""
    best = [len(lengths)]

    def place(k, free):
        if len(free) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(free)
            return
        for j in {f: j for j, f in enumerate(free) if f >= lengths[k]}.values():
            place(k + 1, [f - lengths[k] if i == j else f for i, f in enumerate(free)])
        place(k + 1, [*free, capacity - lengths[k]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), min_size=1, max_size=9))
def test_bound_never_exceeds_the_best_packing(lengths):
    x = np.array(lengths)
    where, offset, bins = K.best_fit_decreasing(x, 24)
    best = best_packing(sorted(lengths, reverse=True), 24)
    assert K.lower_bound(x, 24) <= best <= bins
    for b in range(bins):
        inside = np.argsort(offset[where == b], kind="stable")
        sizes = x[where == b][inside]
        assert (np.cumsum(sizes) - sizes == offset[where == b][inside]).all() and sizes.sum() <= 24
