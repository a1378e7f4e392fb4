import random
import sys
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline as C  # noqa: E402
from formline.llm import curriculum, language, packing, secrets  # noqa: E402
from tests.llm.test_curriculum import targets  # noqa: E402
from tests.llm.test_parity_join import brute as groups  # noqa: E402
from tests.llm.test_secrets import brute as base_spans  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    words = {"en": ["the", "and", "thing", "ofte", "ing"], "es": ["que", "ción", "los", "mente", "para"]}
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "en", "es"])
        text = " ".join("".join(rng.choice(words[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([3, 40, 200])))
        rows.append([i, text, lang, rng.choice(["a", "a", "a", "b", None]), len(text)])
    for i in range(300, 360):
        other = rng.choice(rows[:300])
        rows.append([i, other[1] + rng.choice(["", " more"]), other[2], "c", 0])
    for i in range(360, 370):
        rows.append([i, f"the thing and password=abc{i}def0123456789 ofte " + rows[i - 300][1], None, "d", 0])
    rows += [[370, None, "en", "a", None], [371, "", "en", "a", 0], [372, "12 34 ;;", "en", "b", 8]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(path / "documents.parquet"))
    return path


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    before = {r["doc_id"]: r for r in docs.collect()}

    kept = C.language_id(spark, docs, str(folder))
    assert kept.columns == COLUMNS
    told = {r["doc_id"]: r for r in kept.collect()}
    assert {370, 371, 372}.isdisjoint(told) and len(told) >= 0.99 * (len(before) - 3)
    assert all(r["lang"] in ("en", "es") and r["text"] == before[i]["text"] for i, r in told.items())

    unique = C.jaccard_join(spark, kept, str(folder))
    want = {i for i, (_, c) in groups([(i, r["text"]) for i, r in told.items()])[0].items() if i == c}
    single = {r["doc_id"]: r for r in unique.collect()}
    assert unique.columns == COLUMNS and set(single) == want and len(want) < len(told)

    clean = C.secret_scan(spark, unique, str(folder))
    cleaned = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == COLUMNS and set(cleaned) == set(single)
    for i, r in cleaned.items():
        if base_spans(single[i]["text"]):
            assert "password=abc" not in r["text"] and "<secret>" in r["text"] and r["n_chars"] == len(r["text"])
        else:
            assert tuple(r) == tuple(single[i])

    mixed = C.source_mix(spark, clean, str(folder))
    taken = mixed.collect()
    assert mixed.columns == COLUMNS
    size = {i: len(r["text"].split()) for i, r in cleaned.items()}
    totals: dict = {}
    for i, r in cleaned.items():
        totals[r["source"]] = totals.get(r["source"], 0) + size[i]
    for source, target in targets(totals).items():
        mine = [size[r["doc_id"]] for r in taken if r["source"] == source]
        assert abs(sum(mine) - target) <= max(size[i] for i, r in cleaned.items() if r["source"] == source)

    packed = C.best_fit_packing(spark, mixed, str(folder)).toPandas()
    plain = packing.word_tokens(C.tokenizer_file(packing.TOKENIZER)).tokenizer
    tokens = sum(len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in taken)
    assert packed["length"].sum() == tokens and packed["piece"].eq(0).sum() == len(taken)
    for _, part in packed.groupby("sequence_id"):
        part = part.sort_values("offset")
        ends = np.cumsum(part["length"].to_numpy())
        assert (part["offset"].to_numpy() == ends - part["length"].to_numpy()).all() and ends[-1] <= packing.CAPACITY
    assert packed["sequence_id"].nunique() <= packing.lower_bound(packed["length"].to_numpy()) + 1


def test_run_chains_the_stages(spark, folder):
    names = [name for name, _ in C.STAGES]
    assert names == ["language_id", "jaccard_join", "secret_scan", "source_mix", "best_fit_packing"]
    found = C.run(spark, str(folder))
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 100


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered_queries():
    names = set(driver.queries())
    assert {"pipeline"} <= names and sorted(n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()) == sorted(f"op{i}" for i in range(1, 14))
    assert curriculum.CAP == 2 and language.UNKNOWN == "und" and secrets.KINDS[:3] == ("assign", "access", "hex")
