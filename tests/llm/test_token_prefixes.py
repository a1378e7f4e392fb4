import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from formline.llm import queries
from formline.llm import token_prefixes as T

PATH = queries.tokenizer_file(T.MODEL)
SCHEMA = "doc_id long, text string, tokens string, `a.b` string"
CHOSEN = ["", " ", "  ", "a", " a", "a ", "a  b", "▁a", "▁ ▁▁x", "\n", "a\nb\t\r\nc", "\0x\0", "é", "ﬁＡ", "<s>a</s><unk><0x0A>", "word" * 60, "x" * 400,
          " " * 77, "a" + " " * 33 + "b", "ab" * 100, "日本語のテキスト。漢字", "🙂🙂 emoji🙂", "don't stop, won't!", "....,,,,;;;;", "1234567890 12345"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return T.PrefixCounter(PATH)


def texts(n=150):
    rng = random.Random(5)
    parts = ["the", "ing", " ", "  ", "\n", "▁", "Straße", "tion", "é", "ñ", "a", "aa", "bab", "0x1f", ".", ",", "🙂", "語", "\t", "Hello", "ʃ", "…", "	", "zzz"]
    return CHOSEN + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def brute(model, text, limit):
    counts = [len(model.encode(text[:i])) for i in range(len(text) + 1)]
    at = max(i for i, c in enumerate(counts) if c <= limit)
    return counts, at


def test_every_prefix_has_the_count_of_the_library(model, counter):
    for text in texts():
        counts, _ = brute(model, text, 0)
        assert T._counts(counter.prefix_steps(text)).tolist() == counts, text
        assert counter.cut(text, 0)[0] == counts[-1]


@pytest.mark.parametrize("limit", [0, 1, 2, 3, 7, 20])
def test_longest_prefix(model, counter, limit):
    for text in texts(40):
        counts, at = brute(model, text, limit)
        assert counter.cut(text, limit) == (counts[-1], at, counts[at]), text


def test_stretches_and_forgetting_change_nothing(model, counter, monkeypatch):
    text = " ".join(texts(80)) * 3
    whole = counter.prefix_steps(text)
    monkeypatch.setattr(T, "STRETCH", 50)
    forgetful = T.PrefixCounter(PATH)
    forgetful.total.size = forgetful.written.size = forgetful.follows.size = 5
    assert forgetful.prefix_steps("Stop.") == counter.prefix_steps("Stop.")
    assert forgetful.prefix_steps(text) == whole
    assert forgetful.cut(text, 400) == counter.cut(text, 400)
    assert forgetful.cut(text, 0)[0] == len(model.encode(text))


def test_a_long_text_without_spaces(model, counter):
    text = "".join(random.Random(3).choice("abcdefgh語é") for _ in range(200_000))
    assert counter.cut(text, 0)[0] == len(model.encode(text))


def test_models_that_normalise_are_refused():
    class Other(sentencepiece.SentencePieceProcessor):
        def normalize(self, text, *a, **k):
            return text.lower()

    real = sentencepiece.SentencePieceProcessor
    sentencepiece.SentencePieceProcessor = Other
    try:
        with pytest.raises(ValueError):
            T.PrefixCounter(PATH)
    finally:
        sentencepiece.SentencePieceProcessor = real


def test_rows_and_stored_steps(spark, model):
    rows = [(i, t, "clash", "x") for i, t in enumerate(texts(20))] + [(None, None, None, None), (1, "a", "again", None)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = T.token_prefixes(frame, PATH, limit=5, steps=True)
    assert found.columns == ["doc_id", "text", "a.b", "tokens"]
    asked = found.withColumn("before", T.tokens_before("tokens.steps", F.lit(3))).withColumn("cut", T.longest_prefix("tokens.steps", F.lit(7)))
    result = asked.collect()
    assert len(result) == len(rows)
    for row in result:
        text = row["text"] or ""
        counts, at = brute(model, text, 5)
        assert (row["tokens"]["n_tokens"], row["tokens"]["cut_chars"], row["tokens"]["cut_tokens"]) == (counts[-1], at, counts[at])
        assert row["before"] == counts[min(3, len(text))]
        _, seven = brute(model, text, 7)
        assert (row["cut"]["chars"], row["cut"]["tokens"]) == (seven, counts[seven])
    assert T.token_prefixes(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 10, 57, 99, 100, 10_000])
def test_common_limit(spark, budget):
    counts = [0, 3, 50, 1, 1, 20, 25]
    frame = spark.createDataFrame([(c,) for c in counts] + [(None,)], "n long")
    fits = [limit for limit in range(60) if sum(min(c, limit) for c in counts) <= budget]
    assert T.common_limit("n", frame, budget, width=4) == (None if sum(counts) <= budget else max(fits))


def test_query_counts_whole_texts(spark, model):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n = len(model.encode(texts[row["doc_id"]], num_threads=1))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(texts[row["doc_id"]].encode()), n, n > 4096)
