import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from formline.llm import curriculum, queries
from formline.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(conversations):
    """conversations: id -> list of (role, text)."""
    members = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    rows = []
    for prefix, who in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        leaf = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in members)]
        saved = sum((len(members[p]) - 1) * len((p[-1][1] if p else "").split()) for p in below)
        ends = ",".join(str(c) for c in sorted(c for c in who if len(conversations[c]) == len(prefix)))
        rows.append((min(who), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(who),
                     sum(len(p) == len(prefix) + 1 for p in below), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def in_order(rows):
    found = {}
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in found.items()}


def told(n=60, seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((conv, turn, "user" if turn % 2 == 0 else None, rng.choice(["a", "a", "a b", "a b c", None, ""]), "clash"))
    rows += [(900, 3, "user", "a", None), (900, None, "user", "last words come first", None), (900, 3, "user", "a", None), (900, 3, None, "z", None)]
    rows += [(None, 1, "user", "nobody's", None), (-7, 0, "user", "a", None)]
    rng.shuffle(rows)
    return rows


def trie(spark, rows, **small):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    turns = P.conversation_turns(frame, curriculum.word_count(F.col("text")))
    return sorted((tuple(r[f] for f in FIELDS) for r in P.prefix_trie(turns, **small).collect()), key=str)


# From all in one task, over a few anchors, to every level as a job of its own.
@pytest.mark.parametrize("small", [{}, {"task_paths": 6, "task_turns": 10}, {"task_paths": 1, "task_turns": 0}])
def test_equals_brute_force(spark, small):
    rows = told()
    assert trie(spark, rows, **small) == brute(in_order(rows))


def test_long_conversations_and_empty_tables(spark):
    rows = [(c, t, "user", f"word {t}" if t < 300 else f"{c} {t}", None) for c in (1, 2) for t in range(310)] + [(3, 0, "user", "word 0", None)]
    assert trie(spark, rows) == brute(in_order(rows))
    assert trie(spark, []) == []


def test_conversations_without_turns_belong_to_the_root(spark):
    frame = spark.createDataFrame([(5, []), (4, []), (6, [(bytearray(16), 2)])], "conv_id long, turns array<struct<digest:binary,words:bigint>>")
    rows = sorted((tuple(r[f] for f in FIELDS) for r in P.prefix_trie(frame).collect()), key=str)
    assert rows == [(4, 0, None, 3, 1, 1, 0, hashlib.sha256(b"4,5").hexdigest()), (6, 1, 4, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())]


def test_ids_of_one_node_over_many_tasks(spark, monkeypatch):
    ids = random.Random(1).sample(range(-5_000, 50_000), 6_000)
    frame = spark.createDataFrame([(bytearray(b"hot" if i % 3 else b"%d" % (i % 7)), i) for i in ids], "key binary, conv_id long")
    want = {}
    for i in sorted(ids):
        want.setdefault(b"hot" if i % 3 else b"%d" % (i % 7), []).append(str(i))
    want = {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}
    for size in (P.ID_BYTES, 100):
        monkeypatch.setattr(P, "ID_BYTES", size)
        found, _ = P.ends_digests(frame)
        rows = found.collect()
        assert {bytes(r["key"]): r["sha"] for r in rows} == want and len(rows) == len(want)


def test_turns_do_not_run_into_each_other(spark):
    frame = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("", "abc"), ("1:a", "bc")], "x string, y string")
    keys = [bytes(r[0]) for r in frame.select(P.turn_digest(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 5 and keys[2] == keys[4]


def rebuilt(conversations):
    found = {}
    for conv, turns in conversations.items():
        h = zlib.crc32(str(conv).encode()) % 4
        found[conv] = conversations.get(conv - int(conv % 20 if conv >= 0 else -(-conv % 20)), [])[:h] + turns[h:]
    return found


def test_query_and_sql_rebuild_conversations(spark, tmp_path):
    rows = [(c, t, r, x, n) for c, t, r, x, n in told(70, seed=9)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path)).collect()
    want = brute(rebuilt(in_order(rows)))
    assert sorted((tuple(r[f] for f in FIELDS) for r in found), key=str) == want
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(connection.sql(queries.TRIE_SQL).select(*FIELDS).fetchall(), key=str) == want
