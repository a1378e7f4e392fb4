import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from formline.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string"


def rows():
    long = "".join(f"<p>{i * 7919 % 1000}</p>" for i in range(60_000))
    data = [(1, "http://a/", "<p>same</p>", "x"), (2, "http://b/\r\nX: y%41", "<p>same</p>", None), (9, None, "<p>same</p>", ""), (3, "u", "", ""),
            (4, "u", None, ""), (5, "é\x7f", "naïve", ""), (6, "l", long, ""), (7, "z", "\x00\r\n\r\n" * 9, ""), (8, "s", "a" * 3_000_000, "")]
    return data + [(100 + i, f"http://c/{i}", "<hot>", "") for i in range(300)]


def expected(data, least=0):
    best = {}
    for page, _, html, _ in data:
        best[html or ""] = max(best.get(html or "", -1), page)
    out = {}
    for page, url, html, _ in data:
        body = (html or "").encode()
        revisit = best[html or ""] != page and len(body) >= least
        out[page] = (url, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response",
                     best[html or ""] if revisit else None, None if revisit else body)
    return out


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, least):
    data = rows()
    found = W.archived(spark.createDataFrame(data, SCHEMA).repartition(3), least).collect()
    names = ("url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    got = {r["page_id"]: tuple(bytes(r[n]) if n == "payload" and r[n] is not None else r[n] for n in names) for r in found}
    assert len(found) == len(data) and got == expected(data, least)


def test_archives_are_plain_warc_files(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    manifest = W.write_archives(spark.createDataFrame(rows(), SCHEMA).repartition(2), folder, archive_bytes=20_000)
    listed = {r["file"]: (r["records"], r["bytes"]) for r in manifest.collect()}
    assert len(listed) > 2 and sum(n for n, _ in listed.values()) == len(rows())
    for name, (count, size) in listed.items():
        data = (tmp_path / "out" / name).read_bytes()
        assert len(data) == size
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == count
    stray = tmp_path / "out" / "archive-lost-attempt.warc.gz"  # of a task that ran twice
    stray.write_bytes(W.record(555, "u", b"x", None, False))
    assert W.read_archives(spark, folder, manifest).count() == len(rows())
    assert W.read_archives(spark, folder).count() == len(rows()) + 1


@pytest.fixture
def many_tasks(spark):
    tasks = W.TASKS_PER_FILE + 6
    held = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    yield tasks
    for name, value in before.items():
        spark.conf.set(name, value)


def test_manifest_of_many_tasks_is_few_files(spark, tmp_path, many_tasks):
    folder = f"file://{tmp_path}/out"
    data = [(i, f"u{i}", f"<p>{i % 500}</p>", "") for i in range(1_000)]
    manifest = W.write_archives(spark.createDataFrame(data, SCHEMA), folder)
    listed = [r["file"] for r in manifest.collect()]
    assert len(manifest.inputFiles()) <= 3 < W.TASKS_PER_FILE < len(listed) <= many_tasks  # one may be empty
    assert len(listed) == len(set(listed)) and set(listed) == {f.name for f in (tmp_path / "out").glob("*.gz")}
    found = W.read_archives(spark, folder, manifest, with_payload=False).collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in found if r["refers_to"]) == [(i, i + 500) for i in range(500)]
    assert len(found) == len(data)


def test_damage_is_noticed():
    good = W.record(1, "u", b"hello world", None, False)
    assert [r["payload"] for r in W.records(memoryview(good + good))] == [b"hello world"] * 2
    text = gzip.decompress(good)
    for bad in (text.replace(b"world", b"w0rld"), text.replace(b"Content-Length: 9", b"Content-Length: 8"), text[:-9], b"no record\r\n\r\n"):
        with pytest.raises(ValueError):
            list(W.records(memoryview(gzip.compress(bad))))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    data = [(1, "u", "t", None), (1, "u", "t", None), (None, "u", "t", None), (None, None, None, None)]
    found = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in W.archived(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    assert found == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None)], key=str)
    empty = W.archived(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and "payload" in empty.columns
    assert W.archived(spark.createDataFrame(data, SCHEMA), with_payload=False).filter(F.col("payload").isNotNull()).count() == 0
