import random
import zlib

from pyspark.sql import functions as F

from formline.llm import language as G

SCHEMA = "doc_id long, text string, lang string, score string"
SYLLABLES = {"aa": ["ka", "to", "mi", "ra"], "bb": ["ströh", "gen", "ück", "lei"], "cc": ["ción", "dad", "que", "ra"]}


def held(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


def corpus(docs=400):
    rng = random.Random(2)
    rows = []
    for doc in range(docs):
        lang = rng.choice(list(SYLLABLES))
        word = lambda: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))
        rows.append((doc, " ".join(word().upper() if rng.random() < 0.1 else word() for _ in range(rng.choice([4, 30, 200]))) + ".", lang, "clash"))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA)
    found = G.predict(frame, G.fit(frame)).collect()
    truth = {r[0]: r[2] for r in rows}
    tested = [r for r in found if held(r["doc_id"])]
    assert len(found) == len(rows) and len(tested) > 80
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {r["doc_id"]: r["h"] for r in frame.select("doc_id", G.held_out(F.col("doc_id")).alias("h")).collect()} == {r[0]: held(r[0]) for r in rows}


def test_held_out_and_unlabelled_texts_teach_nothing(spark):
    rows = corpus(200)
    base = spark.createDataFrame(rows, SCHEMA)
    free = next(d for d in range(1000, 2000) if held(d))
    more = spark.createDataFrame([(free, "ka to mi " * 500, "bb", ""), (next(d for d in range(1000, 2000) if not held(d)), "ka to mi " * 500, None, "")], SCHEMA)
    one, two = G.fit(base), G.fit(base.unionByName(more))
    assert one.words.keys() == two.words.keys() and (one.table == two.table).all()


def test_backoff_prefers_words_then_longer_grams(spark):
    model = G.fit(spark.createDataFrame(corpus(), SCHEMA))
    scorer = G.Scorer(model)
    assert "raka" in model.words and scorer.seen["raka"] < scorer.known
    assert "kamitotokami" not in model.words
    assert scorer.predict("kamitotokami")[0] == "aa" and scorer.predict("genlückströhlei")[0] == "bb"
    assert scorer.predict("日本語")[1] <= 1 / 3 + 1e-9  # no gram known: the languages stay even
    short = scorer.predict("ciónciónciónkkk ciónz")
    assert short[0] == "cc"


def test_odd_texts_and_empty_tables(spark):
    rows = corpus(150)
    odd = [(900, None), (901, ""), (902, " 12 + ;\n"), (903, "²Ⅷ"), (904, "x" * 300_000), (905, "ka " * 100_000), (None, "ka to mi")]
    frame = spark.createDataFrame(rows + [(i, t, None, "") for i, t in odd] + rows[:3], SCHEMA)
    found = G.predict(frame, G.fit(frame))
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[905][0] == got[None][0] == "aa"
    assert found.count() == len(rows) + len(odd) + 3
    empty = frame.limit(0)
    assert G.predict(empty, G.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in G.predict(frame, G.fit(empty)).collect()} == {"und"}


def test_word_memory_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(G, "CACHE_WORDS", 20)
    model = G.fit(spark.createDataFrame(corpus(), SCHEMA))
    rng = random.Random(8)
    text = " ".join("".join(rng.choice(SYLLABLES["bb"]) for _ in range(6)) for _ in range(300))
    small, large = G.Scorer(model), G.Scorer(model)
    large.extra = large.extra.repeat(100, axis=0)
    assert small.predict(text)[0] == "bb" and small.predict(text) == small.predict(text)
    assert len(small.seen) <= len(model.words) + 20
