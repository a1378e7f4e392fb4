import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import licenses as L

SCHEMA = "doc_id long, text string, license string, label string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w, places, blocks = words(text), [], []
    for phrase, label in L.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    for label, notice in L.TEMPLATES:
        t = words(notice)
        needed = L.words_needed(len(set(t)))
        for start in range(0, len(w), len(t)):
            shared = len(set(t) & set(w[start:start + 2 * len(t)]))
            if shared >= needed:
                blocks.append((label, start, min(len(w), start + 2 * len(t)), shared / len(set(t)), set(t)))
    blocks = [b[:4] for b in blocks]
    base = sorted({label for _, label in places})
    starts = [s for s, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
            1.0 if places else max((b[3] for b in blocks), default=0.0), sorted(blocks))


def texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 8)))
    noise = lambda n: " ".join(word() for _ in range(n))
    out = [None, "", "MIT License", "mit\nlicense. MIT-license mit licenses", "the general public  license general public license", "Apache/License 2",
           "xmit license", "mit ß license", "general general public license", "İ mit license", noise(3000) + " MIT LICENSE " + noise(500)]
    for _, notice in L.TEMPLATES:
        tokens = notice.split()
        for drop in (0, 1, 2, 5):
            kept = list(tokens)
            for _ in range(min(drop, len(kept) - 1)):
                kept[rng.randrange(len(kept))] = word()
            out.append(noise(rng.randrange(0, 90)) + "\n" + "\n".join([" ".join(kept[:7]), " ".join(kept[7:])]) + " " + noise(rng.randrange(0, 90)))
    return out + [" ".join(out[12:40])] + out[:5]


SIZE = {label: {w for other, text in L.TEMPLATES if other == label for w in words(text)} for label, _ in L.TEMPLATES}


def test_equals_brute_force(spark):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts())]
    found = L.license_notices(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["doc_id", "text", "label", "license"]
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "score")
    matched = 0
    for row in found.collect():
        got, want = row["license"], brute(row["text"])
        assert tuple(got[n] for n in names) == want[:6], row["text"]
        assert sorted(tuple(b)[:4] for b in got["blocks"]) == want[6]
        shown = {b["label"] for b in got["blocks"] if not b["inside"]}
        assert got["labels"] == ",".join(sorted(shown | set(want[4].split(",")) - {""}))
        # A block counts as explained only beside a larger template's one.
        for b in got["blocks"]:
            if b["inside"]:
                assert any(o["start"] < b["end"] and b["start"] < o["end"] and SIZE[b["label"]] & SIZE[o["label"]] for o in got["blocks"] if o != b)
        matched += bool(want[6])
    assert matched > 30


BY, NC, SA = "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0", "Licensed under CC BY-SA 4.0"
SHORT_APACHE, LONG_APACHE, FAR = L.TEMPLATES[3][1], L.TEMPLATES[2][1], " word" * 60 + " "


@pytest.mark.parametrize("text, labels", [
    (NC, ["cc-by-nc"]), (f"{NC}. {NC}", ["cc-by-nc"]), (f"{NC}, {SA}", ["cc-by-nc", "cc-by-sa"]), (BY + FAR + NC, ["cc-by", "cc-by-nc"]),
    (SA + FAR + BY, ["cc-by", "cc-by-sa"]), (f"{BY} {NC}", ["cc-by", "cc-by-nc"]), (f"{NC} {BY}", ["cc-by", "cc-by-nc"]), (f"a {SA} and {BY}.", ["cc-by", "cc-by-sa"])])
def test_a_notice_beside_a_larger_one_keeps_its_label(spark, text, labels):
    found = L.license_notices(spark.createDataFrame([(1, text, None, None)], SCHEMA)).first()["license"]
    assert sorted({b["label"] for b in found["blocks"] if not b["inside"]}) == labels and found["labels"] == ",".join(labels)


def test_a_short_notice_keeps_its_block_when_the_long_one_stands_elsewhere(spark):
    texts = [LONG_APACHE, SHORT_APACHE + FAR + LONG_APACHE, LONG_APACHE + FAR + SHORT_APACHE]
    found = L.license_notices(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)).orderBy("doc_id").collect()
    width = len(words(SHORT_APACHE))
    short = [[b["start"] for b in r["license"]["blocks"] if b["end"] - b["start"] <= 2 * width and not b["inside"]] for r in found]
    assert short[0] == [] and short[1] == [0] and len(short[2]) >= 1


def test_prefix_is_rarest_by_all_texts(spark):
    frame = spark.createDataFrame([(1, "free " * 50 + "charge", None, None), (2, "of the of the", None, None)], SCHEMA)
    vocabulary = L.vocabulary(L.TEMPLATES, L.PHRASES)
    times = dict(zip(vocabulary, L.frequencies(frame, vocabulary, "text")))
    assert (times["free"], times["charge"], times["of"], times["mit"]) == (50, 1, 2, 0)
    index = L.build_index(frame)
    for template in index.templates:
        assert len(template.prefix) == len(template.tokens) - template.needed + 1 and max(template.prefix) <= min(set(template.tokens) - template.prefix, default=10**9)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_empty_tables(spark, rows):
    found = L.license_notices(spark.createDataFrame(rows, SCHEMA)).select(F.col("license.n_words").alias("n"), F.col("license.score").alias("s"))
    assert [tuple(r) for r in found.collect()] == [(0, 0.0)] * len(rows)


def test_a_megabyte_of_notices_takes_seconds():
    words_of = [w for n in range(20_000) for w in words(L.TEMPLATES[n % 15][1])][:180_000]
    vocabulary = {w: i for i, w in enumerate(L.vocabulary(L.TEMPLATES, L.PHRASES))}
    index = L.Index(None, None, [], [], None)
    for label, text in L.TEMPLATES:
        sequence = [vocabulary[w] for w in words(text)]
        tokens = sorted(set(sequence))
        needed = L.words_needed(len(tokens))
        index.templates.append(L.Template(label, tokens, len(sequence), needed, frozenset(tokens[: len(tokens) - needed + 1]), sequence))
    began = time.process_time()
    at, token = np.arange(len(words_of)), np.array([vocabulary[w] for w in words_of])
    whole = L.matching_blocks(at, token, len(words_of), index)
    took = time.process_time() - began
    assert len(whole) > 10_000 and took < 30
    part = L.matching_blocks(at[:3_000], token[:3_000], 3_000, index)
    near = lambda blocks: sorted(b for b in blocks if b[2] < 2_800)
    assert near(part) == near(whole)
