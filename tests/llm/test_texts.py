import numpy as np
import pyarrow as pa

from formline.llm import licenses, packing, parity_join, texts
from formline.llm.queries import tokenizer_file


def thue_morse(n):
    """A word and its complement that collide under any polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


PAIRS = [thue_morse(n) for n in (64, 128, 1024, 2048)]


def hashes(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = texts.word_bounds(data, np.array([0, len(data)]), texts.NOT_SPACE)
    with np.errstate(over="ignore"):
        return texts.word_hashes(data, starts, ends), data, starts, ends


def test_words_of_any_length_have_their_own_hash():
    words = [w for pair in PAIRS for w in pair] + ["a" * n for n in range(1, 600)] + ["a" * n + "b" for n in range(600)] + ["\0" * n for n in range(1, 40)] + ["é" * 300]
    found, *_ = hashes(words)
    assert len(set(found.tolist())) == len(set(words))
    again, *_ = hashes(["x", *reversed(words)])
    assert again[1:].tolist() == found[::-1].tolist()  # wherever they stand


def test_bytes_are_compared():
    _, data, starts, ends = hashes(["abcdefghijkl", "abcdefghijkl", "abcdefghijkx", "a"])
    assert texts.same_bytes(data, starts[1:2], ends[1:2], starts[:1]) and not texts.same_bytes(data, starts[2:3], ends[2:3], starts[:1])


def test_token_ids_of_words_that_share_a_hash(monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_file(packing.TOKENIZER)
    plain = Tokenizer.from_file(path)
    text = " ".join([w for pair in PAIRS[2:] for w in pair] + ["one", "two", "six"])
    want = plain.encode(text, add_special_tokens=False).ids
    data = np.frombuffer(text.encode(), np.uint8)
    assert packing.WordTokens(path).encode(data, np.array([0, len(data)]))[0].tolist() == want
    # Even if all words of a length shared one hash.
    monkeypatch.setattr(packing, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    assert packing.WordTokens(path).encode(data, np.array([0, len(data)]))[0].tolist() == want


def test_shingles_and_licence_words_tell_such_words_apart(spark):
    (a, b), (c, d) = PAIRS[2:]
    sets = list(texts.sets_of_batch(pa.array([a, b, f"{a} x y z {c}", f"{b} x y z {c}", f"{a} x y z {d}"])))
    assert len({tuple(s.tolist()) for s in sets}) == 5
    assert len(set(licenses.hashes_of([a, b, c, d]).tolist())) == 4
    rows = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in parity_join.near_duplicates(rows).collect()} == {1: 1, 2: 2, 3: 1}
