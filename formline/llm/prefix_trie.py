"""Tries of conversations by truncation peeling: from the deepest level up, strip the last turn and regroup.

A conversation is the row of its turns' digests. Equal conversations become one path first. Paths under a
prefix that few share are peeled inside a task, the levels above them as Spark aggregates, one per level.
Every node is found and its aggregates are complete in the same pass, as a level has seen all deeper ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.operators.layout import remove_scratch, stored

KEY_BYTES = 16
ROOT = bytes(KEY_BYTES)
# A prefix is peeled inside a task if it has at most so many paths, or so many turns below it.
TASK_PATHS, TASK_TURNS = 64, 2_000
# Ids of one node are joined to texts of about so many bytes before they meet.
ID_BYTES = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ("depth int, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, keys array<binary>, words array<long>")
_NODE = pa.schema([
    ("depth", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("keys", pa.list_(pa.binary())), ("words", pa.list_(pa.int64()))])


def turn_digest(*columns: Column) -> Column:
    """16 bytes that stand for the texts of a turn; null counts as empty, and no two rows of texts run into one."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    whole = F.concat(*[part for t in texts for part in (F.octet_length(t).cast("string"), F.lit(":"), t)])
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, KEY_BYTES)


def conversation_turns(turns: DataFrame, words: Column, conv_col: str = "conv_id", turn_col: str = "turn",
                       text_cols: tuple[str, ...] = ("role", "text")) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest, words).

    The order is by turn, null first; equal turns go by their texts, so repeated rows are turns of their own.
    Rows without a conversation id are left out.
    """
    rows = turns.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        turn_digest(*[F.col(f"`{c}`") for c in text_cols]).alias("digest"), words.cast("long").alias("words"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"text{i}") for i, c in enumerate(text_cols)])
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), *[f"text{i}" for i in range(len(text_cols))])
    placed = rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")
    return placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of every prefix: a digest of the key before it and the turn."""
    for batch in batches:
        last, keys = [], []
        for row in batch.column(1).to_pylist():
            key, chain = ROOT, []
            for digest in row:
                key = hashlib.blake2b(key + digest, digest_size=KEY_BYTES).digest()
                chain.append(key)
            last.append(key)
            keys.append(chain)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, keys), pa.int32()), pa.array(last, pa.binary()), pa.array(keys, pa.list_(pa.binary())), batch.column(2)],
            ["conv_id", "depth", "key", "keys", "words"])


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, id): the SHA-256 of each key's ids, or pieces of their text where other tasks may hold more."""
    names, opened = ["key", "first", "ids", "sha"], True  # of an open key only pieces of text leave

    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], kind) for i, kind in enumerate(
            (pa.binary(), pa.int64(), pa.string(), pa.string()))], names)

    key, ids, size, found = None, [], 0, []
    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key or size > ID_BYTES:
                if key is not None:
                    # The first key of a task may begin in another one, and a cut key goes on here.
                    whole = k != key and not opened
                    text = ",".join(map(str, ids))
                    found.append((key, ids[0], None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))
                opened = key is None or k == key
                key, ids, size = k, [], 0
            ids.append(i)
            size += len(str(i)) + 1
        if len(found) > 5_000 or size > ID_BYTES:
            yield rows(found)
            found = []
    if key is not None:
        found.append((key, ids[0], ",".join(map(str, ids)), None))
    yield rows(found)


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of text sorted by (key, first id): the SHA-256 of each key's text, read as a stream."""
    key, sha, found = None, None, []
    for batch in batches:
        for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != key:
                if key is not None:
                    found.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
    if key is not None:
        found.append((key, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()), pa.array([s for _, s in found], pa.string())], ["key", "sha"])


def ends_digests(ended: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, sha): SHA-256 of the comma-joined ascending ids of every key; and the stored table behind it.

    The ids of a key may fill many tasks: they are range-partitioned, and what meets in one task at last are
    pieces of ``ID_BYTES``, hashed as a stream.
    """
    parts = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ended.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = stored(ranged.mapInArrow(_id_runs, "key binary, first long, ids string, sha string"), "id-runs")
    pieces = runs.filter("sha is null").repartition("key").sortWithinPartitions("key", "first")
    return runs.filter("sha is not null").select("key", "sha").unionByName(pieces.mapInArrow(_joined_runs, "key binary, sha string")), runs


def _peeled(batches: Iterator[pa.RecordBatch], anchor: int) -> Iterator[pa.RecordBatch]:
    """Paths sorted by their key at depth ``anchor``: all nodes from the deepest up to the anchor's own."""
    def groups():
        group, at = [], None
        for batch in batches:
            for row in batch.to_pylist():
                top = row["keys"][anchor - 1]
                if group and top != at:
                    yield group
                    group = []
                at = top
                group.append(row)
        if group:
            yield group

    waiting = []
    for group in groups():
        for nodes in _levels(group, anchor):
            waiting += nodes
            if len(waiting) > 5_000:
                yield pa.RecordBatch.from_pylist(waiting, _NODE)
                waiting = []
    yield pa.RecordBatch.from_pylist(waiting, _NODE)


def _levels(paths: list[dict], anchor: int) -> Iterator[list[dict]]:
    ended: dict[int, list[dict]] = {}
    for path in paths:
        ended.setdefault(path["depth"], []).append(path)
    nodes: dict[bytes, dict] = {}  # of the level above, as far as its children tell
    children: list[dict] = []
    for depth in range(max(ended), anchor - 1, -1):
        for path in ended.get(depth, ()):  # newly ended conversations join the surviving nodes
            node = nodes.setdefault(path["key"], _empty(path))
            _add(node, path["conv_id"], path["n"], 0, 0, 0)
            node["ends_sha256"] = path["sha"]
        for key, node in nodes.items():
            node |= {"depth": depth, "key": key, "parent_key": node["chain"][depth - 2] if depth > 1 else ROOT}
            node["n_leaves"] = node["n_leaves"] or 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["weights"][depth - 1]
        for child in children:
            child["parent_conv_id"] = nodes[child["parent_key"]]["conv_id"]
        yield children
        children = list(nodes.values())
        nodes = {}
        if depth > anchor:
            for child in children:  # strip the last turn
                _add(nodes.setdefault(child["parent_key"], _empty({"keys": child["chain"], "words": child["weights"]})),
                     child["conv_id"], child["n_convs"], 1, child["n_leaves"], child["saved_tokens"])
    for child in children:
        child |= {"keys": child["chain"][:anchor], "words": child["weights"][:anchor]}
    yield children


def _empty(path: dict) -> dict:
    return {"conv_id": None, "parent_conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "ends_sha256": EMPTY_SHA,
            "chain": path["keys"], "weights": path["words"], "keys": None, "words": None}


def _add(node: dict, least: int, convs: int, children: int, leaves: int, saved: int) -> None:
    node["conv_id"] = least if node["conv_id"] is None else min(node["conv_id"], least)
    node["n_convs"] += convs
    node["n_children"] += children
    node["n_leaves"] += leaves
    node["saved_tokens"] += saved


def _level(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level from the conversations that end there and the stripped nodes of the level below."""
    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("sha").alias("sha"),
        F.first("keys").alias("keys"), F.first("words").alias("words"))
    last = F.element_at("words", depth) if depth else F.lit(0)
    parent = F.element_at("keys", depth - 1) if depth > 1 else F.lit(ROOT) if depth else F.lit(None)
    return nodes.select(
        F.lit(depth).alias("depth"), "key", parent.cast("binary").alias("parent_key"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * last).alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"), "keys", "words")


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.select(
        F.col("parent_key").alias("key"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.lit(None).cast("string").alias("sha"), F.slice("keys", 1, depth - 1).alias("keys"), F.slice("words", 1, depth - 1).alias("words"))


def _ended(paths: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return paths.select("key", "conv_id", F.col("n").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"),
                        zero.alias("saved_tokens"), "sha", "keys", "words")


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(key, depth, keys, words, conv_id, n, sha), stored: each distinct conversation once.

    ``conversations``: conv_id, and turns as (digest, words). conv_id is the smallest of equal ones, n their
    number, sha the SHA-256 of their ids.
    """
    chained = conversations.select("conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"),
                                   F.transform("turns", lambda t: t["words"]).alias("words"))
    ended = stored(chained.mapInArrow(_chained, "conv_id long, depth int, key binary, keys array<binary>, words array<long>"), "ended")
    digests, runs = ends_digests(ended)
    once = ended.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.first("depth").alias("depth"), F.first("keys").alias("keys"),
        F.first("words").alias("words"))
    paths = stored(once.join(digests, "key"), "paths")
    remove_scratch(ended)
    remove_scratch(runs)
    return paths


def prefix_trie(conversations: DataFrame, task_paths: int = TASK_PATHS, task_turns: int = TASK_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns, the root (depth 0) the empty one. conv_id: the smallest of
    its members, which are the conversations that start with it. n_leaves: childless nodes in its subtree;
    saved_tokens: summed over its subtree, (members - 1) times the words of the last turn; ends_sha256: of the
    ids of the conversations that are the node's whole sequence. Repeated conversations are members each; one
    without turns belongs to the root alone. An empty table has no node.
    """
    paths = conversation_paths(conversations)
    rest, upper, peeled, anchor = paths, [], [], 1
    while True:
        upper.append(rest.filter(F.col("depth") < anchor))
        deep = rest.filter(F.col("depth") >= anchor).withColumn("top", F.element_at("keys", anchor))
        sizes = deep.groupBy("top").agg(F.count(F.lit(1)).alias("paths"), F.sum("depth").alias("turns"))
        sized = stored(deep.join(sizes.select("top", ((F.col("paths") > task_paths) & (F.col("turns") > task_turns)).alias("large")), "top"), "anchored")
        small = sized.filter("not large").repartition("top").sortWithinPartitions("top").select("key", "depth", "keys", "words", "conv_id", "n", "sha")
        at = anchor
        peeled.append((anchor, stored(small.mapInArrow(lambda batches, at=at: _peeled(batches, at), NODE), "peeled")))
        rest = sized.filter("large").select(*paths.columns)
        if rest.isEmpty():
            remove_scratch(sized)
            break
        anchor *= 2
    ended = upper[0]
    for rows in upper[1:]:
        ended = ended.unionByName(rows)
    levels, below = [], None
    for depth in range(anchor, -1, -1):
        rows = _ended(ended.filter(F.col("depth") == depth))
        nodes = _level(rows.unionByName(_stripped(below, depth + 1)) if below is not None else rows, depth)
        # The tops of peeled subtrees are whole already.
        tops = [table.filter(F.col("keys").isNotNull()) for a, table in peeled if a == depth]
        below = stored(nodes.unionByName(tops[0]) if tops else nodes, f"level-{depth}")
        levels.append(below)
    above = levels[0]
    for nodes in levels[1:]:
        above = above.unionByName(nodes)
    parents = above.filter(F.col("depth") < anchor).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("known"))
    placed = above.drop("parent_conv_id").join(parents, "parent_key", "left").withColumnRenamed("known", "parent_conv_id")
    columns = ["conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = placed.select(*columns)
    for _, table in peeled:
        found = found.unionByName(table.filter(F.col("keys").isNull()).select(*columns))
    return found
