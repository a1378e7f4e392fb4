import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from formline.llm import collocations as C
from formline.llm import queries
from formline.llm.quotient_filter import Layout

SCHEMA = "doc_id long, text string, lang string, rank string, `a.b` string"
FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least, longest=4, top=C.TOP):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lowered = (text or "").translate({c: c + 32 for c in range(0x41, 0x5B)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    phrases = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    found = {}
    for (lang, words), a in phrases.items():
        score, k = min((2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words)))
        inside = lambda other: any(other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1))
        if not any(other == lang and len(longer) > len(words) and inside(longer) and 100 * f >= 80 * a for (other, longer), f in phrases.items()):
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return [(lang, place, phrase.decode(), -a, l, r, n[lang], -score)
            for lang, rows in sorted(found.items()) for place, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1)]


def texts(n=250, seed=1):
    rng = random.Random(seed)
    common = ["of", "the", "New", "york", "city", "hall", "Straße", "é", "\0", "a", "a", "a"]
    rows = []
    for i in range(n):
        words = [rng.choice(common) if rng.random() < 0.8 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.4:
            words += ["New", "York", "City", "Hall"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "fr", None]), "clash", "x"))
    return rows + [(None, None, "en", None, None), (1, "", "de", None, None), (2, " \t. \n", "de", None, None)] + rows[:20]


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r[f] for f in FIELDS) for r in C.collocations(frame, **options).collect())


@pytest.mark.parametrize("least, longest, top", [(5, 4, 2_000), (2, 4, 7), (1, 3, 50), (30, 2, 2_000), (9, 4, None)])
def test_equals_brute_force(spark, least, longest, top):
    rows = texts()
    assert found(spark, rows, least=least, longest=longest, top=top) == sorted(brute(rows, least, longest, top or 10**9))


def test_small_blocks_and_buckets_change_nothing(spark, monkeypatch):
    rows = texts(120, seed=3)
    want = sorted(brute(rows, 4))
    monkeypatch.setattr(C, "BUCKET_GRAMS", 40)  # many buckets
    for size in (1, 300):
        monkeypatch.setattr(C, "BLOCK_WORDS", size)
        assert found(spark, rows, least=4) == want


def test_empty_tables_and_long_texts(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, None, None, None), (2, "once only", "en", None, None)]) == []
    rng = random.Random(2)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta.", "x" * 300]) for _ in range(60_000))
    rows = [(1, long, "en", None, None), (2, "one two " * 30_000, "en", None, None)]
    assert found(spark, rows) == sorted(brute(rows, 30))


def test_stretches_keep_pieces_whole(monkeypatch):
    text = "a b c. d e f, g\th\nI J K"
    whole = [w for words in C.stretches(text.encode()) for w in words]
    monkeypatch.setattr(C, "STRETCH", 2)
    parts = list(C.stretches(text.encode()))
    assert [w for words in parts for w in words] == whole and len(parts) > 2
    assert all(words[-1] == C.END for words in parts[:-1])


@pytest.mark.parametrize("words, bits", [(1, 5), (2, 1), (2, 17), (2, 32), (3, 9), (3, 32), (4, 16), (4, 17), (4, 32)])
def test_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    high = min(2**bits, 1 << 32)
    grams = [np.concatenate([rng.integers(0, high, 3_000), np.zeros(50, np.int64), np.full(70, high - 1)]).astype(np.uint32) for _ in range(words)]
    layout = Layout(words, bits)
    left, right = layout.permuted(grams)
    assert all((a == b).all() for a, b in zip(layout.restored(left, right), grams))
    want = Counter(zip(*[g.tolist() for g in grams]))
    keys_left, keys_right, counts, place = layout.counted(left, right)
    assert dict(zip(zip(*[c.tolist() for c in layout.restored(keys_left, keys_right)]), counts.tolist())) == want
    assert (keys_left[place] == left).all() and (keys_right[place] == right).all()
    bucket_bits = min(3, layout.left_bits)
    read = [layout.read(layout.written(keys_left[a:b], keys_right[a:b], counts[a:b], bucket_bits), bucket, bucket_bits)
            for bucket, a, b in C._bucket_bounds(layout.bucket(keys_left, bucket_bits))]
    again = [np.concatenate(column) for column in zip(*read)]
    assert (again[0] == keys_left).all() and (again[1] == keys_right).all() and (again[2] == counts).all()
    twice = layout.counted(*[np.concatenate([c, c]) for c in again])
    assert (twice[2] == 2 * counts).all() and (twice[0] == keys_left).all()


def test_word_numbers_of_more_than_32_bits_are_refused():
    with pytest.raises(OverflowError):
        Layout(2, 33)


def test_sql_equals_brute_force():
    rows = [(i, t, lang, None, None) for i, t, lang, *_ in texts(400, seed=6)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    assert sorted(connection.sql(queries.COLLOCATION_SQL).select(*FIELDS).fetchall()) == sorted(brute(rows, 30))
