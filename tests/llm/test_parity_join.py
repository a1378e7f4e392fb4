import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import parity_join as P
from formline.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """id -> (size, smallest id reachable), by comparing everything with everything."""
    sets, root = {i: shingles(t) for i, t in rows}, {}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids, links = sorted(sets), set()
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                links.add((a, b))
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}, links


def corpus(seed=3):
    """Unrelated texts, chains of edits, copies, a passage that many share, borderline pairs, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    texts = []
    passage = [word() for _ in range(70)]
    for _ in range(40):
        texts.append([word() for _ in range(rng.randrange(20, 200))] + passage)
    for length in (8, 30, 90, 300, 1500):
        chain = [word() for _ in range(length)]
        for step in range(12):
            texts.append(list(chain))
            for _ in range(rng.choice([1, 1, max(1, length // 60)])):
                chain[rng.randrange(len(chain))] = word()
    for length in (64, 65, 68, 69, 80, 256, 260, 340, 345):  # on either side of the bands, and of the threshold
        base = [word() for _ in range(length)]
        for part in (0.74, 0.75, 0.76, 0.8, 0.9):
            texts.append(base[: int(length * part) + 2])
        texts.append(base)
    out = [" ".join(t) for t in texts]
    out += ["", "   \n\t ", None, "one two", "One TWO", "one  two", "one two three four", "a a a a a a a a", "A a a a a a", "  x", "café CAFÉ"]
    out += [out[3]] * 30 + [out[3].upper(), out[5].replace(" ", "\n")]
    rng.shuffle(out)
    return list(enumerate(out))


def test_components_equal_brute_force(spark):
    rows = corpus()
    want, pairs = brute(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in P.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert found == want
    assert len(pairs) > 200


def test_links_equal_brute_force(spark):
    rows = corpus(9)
    _, pairs = brute(rows)
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    want = {frozenset((sets[a], sets[b])) for a, b in pairs if sets[a] != sets[b]}
    found = P.sketch(spark.createDataFrame(rows, "id long, text string"))
    classes = {r["fp"]: sets[r["id"]] for r in found.digests.collect() if r["n"]}
    got = P.links(found).collect()
    assert {frozenset((classes[r["a"]], classes[r["b"]])) for r in got} == want
    for r in got:
        a, b = classes[r["a"]], classes[r["b"]]
        assert (r["common"], r["united"]) == (len(a & b), len(a | b))


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    for n in (5, 64, 65, 200, 1000, 5000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, 1, n // 8, n // 4):
            other = base.copy()
            other[:changed] = rng.integers(0, 1 << 63, changed, dtype=np.uint64)
            a, b = np.unique(base), np.unique(other)
            difference = len(np.setxor1d(a, b))
            with np.errstate(over="ignore"):
                for band in {P.band_of(n), max(0, P.band_of(n) - 1)}:
                    x, y = P.sketch_pieces(a, band), P.sketch_pieces(b, band)
                    assert len(np.setdiff1d(x, y)) <= difference and len(np.setdiff1d(y, x)) <= difference
                apart = np.bitwise_xor(P.short_sketch(a), P.short_sketch(b)).view(np.uint64)
                assert np.bitwise_count(apart).sum() <= difference
    assert all(P.most_differences(n, False) >= P.most_differences(n, True) for n in range(1, 2000))


def test_without_near_duplicates_keeps_one_of_each_group(spark):
    rows = corpus(4)
    want, _ = brute(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("fp", F.col("doc_id") * 2)
    kept = P.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_repeated_and_null_ids(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(1, text), (1, text), (1, "something else that nobody wrote before now"), (2, text + " today"), (3, None), (3, None),
            (None, text), (None, ""), (4, "something else that nobody wrote before now")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = P.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    assert all(r["component_id"] is None for r in found if r["doc_id"] is None)
    kept = P.without_near_duplicates(frame).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == sorted(
        [(1, text), (1, "something else that nobody wrote before now"), (3, ""), (3, ""), (0, text), (0, "")])


@pytest.mark.parametrize("operator", [P.near_duplicates, P.without_near_duplicates])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1500)] + [(7000, 7000), (None, 5), (9001, 9000), (9000, 9001)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    root = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            root[a].add(b), root[b].add(a)
    want = {}
    for start in sorted(root):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in want:
                want[node] = start
                stack += root[node]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_of_a_long_row_are_hashed_in_chunks(monkeypatch):
    from formline.llm import texts as T

    rng = random.Random(0)
    text = " ".join("".join(rng.choice("abé\n\t") for _ in range(rng.randrange(1, 9))) for _ in range(4_000)).encode()
    data = np.frombuffer(text, np.uint8)
    with np.errstate(over="ignore"):
        want, _ = T.hashed_words(data, np.array([0, len(data)]), T.NOT_SPACE)
        monkeypatch.setattr(T, "SLICE_BYTES", 700)
        monkeypatch.setattr(T.chunks, "__defaults__", (700,))
        got, firsts = T.hashed_words(data, np.array([0, len(data)]), T.NOT_SPACE)
    assert (got == want).all() and len(want) == len(text.split()) and firsts.tolist() == [0, len(want)]
