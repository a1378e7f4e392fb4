"""Word-shingle Jaccard join by parity sketches: exact links and components at a similarity of 0.75."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.components import connected_components
from formline.llm.texts import mix, sets_of_batch
from formline.operators.layout import remove_scratch, stored, unused_name

WIDTH = 5
# Similarity 3/4: two sets link when 100 * common >= 75 * united.
NUMERATOR, DENOMINATOR = 3, 4
# Sets of up to BAND tokens keep each token as a piece of its own; the band (s, 4 s] has PIECES * s pieces.
BAND, PIECES = 64, 2
# A bitmap of this many bits tells which documents to look at again; fuller, it only lets more through.
BITMAP_BITS = 1 << 24
MERGE_ROUNDS = 2
# Bits of the short sketch by which a pair is judged before its sets are fetched.
SHORT_BITS = 1024
SHORT = [f"s{i}" for i in range(SHORT_BITS // 64)]


def band_of(n: int) -> int:
    """0 for up to BAND tokens, then 1, 2, ... for each factor of 4."""
    band, top = 0, BAND
    while n > top:
        band, top = band + 1, top * 4
    return band


def most_differences(n: int, larger: bool) -> int:
    """The largest symmetric difference to a linked set: |A ^ B| <= (|A| + |B|) / 7, with |B| <= 4/3 |A|.

    ``larger``: only partners of at most the same size count.
    """
    other = n if larger else n * DENOMINATOR // NUMERATOR
    return (n + other) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def sketch_pieces(tokens: np.ndarray, band: int) -> np.ndarray:
    """The non-empty pieces of a set's parity sketch in a band, as 64-bit keys.

    Each token flips one bit of a sketch of very many bits, cut into pieces; a piece is known by the XOR of
    its tokens' hashes. A token in one set only changes one piece at most, so the number of differing
    pieces is a lower bound of the symmetric difference.
    """
    salt = np.uint64(band * 0x9E37 + 1)
    if band == 0:
        return mix(tokens ^ salt)
    count = np.uint64(PIECES * BAND * 4 ** (band - 1))
    piece = mix(tokens ^ mix(np.array([salt]))) % count
    order = np.argsort(piece, kind="stable")
    piece, hashed = piece[order], mix(tokens[order])
    starts = np.flatnonzero(np.diff(piece, prepend=~piece[:1]))
    return mix(np.bitwise_xor.reduceat(hashed, starts) + mix(piece[starts] * np.uint64(2) + np.uint64(1)) + mix(np.array([salt])))


def short_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the tokens that hash to each of SHORT_BITS bits: its Hamming distance is a lower bound as well."""
    bits = np.bincount((mix(tokens ^ np.uint64(0x3C3C3C3C3C3C3C3C)) % np.uint64(SHORT_BITS)).astype(np.int64), minlength=SHORT_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def set_keys(tokens: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(side, slack, keys) for the set's own band and, if a smaller partner may lie there, the band below.

    Linked sets agree in all pieces but ``most_differences``; of its keys a set may therefore leave out any
    ``slack`` that come first in an order all sets share, and still meets every linked set in the others.
    """
    n, found = len(tokens), []
    band = band_of(n)
    for side, b in ((0, band), (1, band - 1)):
        if side and (band == 0 or -(-n * NUMERATOR // DENOMINATOR) > BAND * 4 ** b):
            continue
        keys = sketch_pieces(tokens, b)
        slack = len(keys) - 1 - most_differences(n, larger=bool(side))
        if slack < 0:  # so many tokens met in few pieces; practically impossible, but then no key may decide
            raise ValueError(f"{n} tokens left {len(keys)} pieces; choose another salt")
        found.append((side, slack, keys))
    return found


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit fingerprints of a set."""
    a = mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))]))
    b = np.bitwise_xor.reduce(mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), keepdims=True)
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _digest(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second = [], [], []
            with np.errstate(over="ignore"):
                for tokens in sets_of_batch(batch.column(1), width):
                    f, g = fingerprint(tokens) if len(tokens) else (0, 0)
                    sizes.append(len(tokens)), first.append(f), second.append(g)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                ["id", "n", "fp", "fq"])
    return run


def _emit_keys(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task give their keys once, like a map-side combine
        for batch in batches:
            keys, prints, tags, rows = [], [], [], 0
            with np.errstate(over="ignore"):
                for tokens in sets_of_batch(batch.column(0), width):
                    if not len(tokens):
                        continue
                    f, _ = fingerprint(tokens)
                    if f in seen:
                        continue
                    seen.add(f)
                    for side, slack, found in set_keys(tokens):
                        keys.append(found.view(np.int64))
                        prints.append(np.full(len(found), f, np.int64))
                        tags.append(np.full(len(found), slack * 2 + side, np.int32))
                        rows += len(found)
                    if rows > 200_000:
                        yield _key_rows(keys, prints, tags)
                        keys, prints, tags, rows = [], [], [], 0
            if rows:
                yield _key_rows(keys, prints, tags)
    return run


def _key_rows(keys, prints, tags) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, prints, tags)], ["key", "fp", "tag"])


def _needed_sets(width: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(bitmap.value, np.uint64)
        for batch in batches:
            bit = batch.column(2).to_numpy()
            asked = (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(asked.astype(bool)))
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                with np.errstate(over="ignore"):
                    sets = list(sets_of_batch(part.column(1), width))
                    prints = [fingerprint(x)[0] if len(x) else 0 for x in sets]
                    short = np.array([short_sketch(x) for x in sets], np.int64).reshape(-1, len(SHORT))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(prints, pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary()),
                     *[pa.array(short[:, j]) for j in range(len(SHORT))]], ["id", "fp", "tokens", *SHORT])
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common.append((len(x), len(y), int((y[at] == x).sum())))
        keep = [100 * c >= 75 * (m + n - c) for m, n, c in common]
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([c for _, _, c in common], pa.int64()),
             pa.array([m + n - c for m, n, c in common], pa.int64())], ["a", "b", "common", "united"])
        yield out.filter(pa.array(keep, pa.bool_()))


@dataclass
class Sketches:
    """What the join has written to the shared folder."""

    digests: DataFrame  # id, n, fp: one row per document
    keys: DataFrame  # key, fp, n, common: the keys that decide, of sets that share one
    sets: DataFrame  # fp, tokens and short sketch of those


def sketch(docs: DataFrame, width: int = WIDTH) -> Sketches:
    """Shingle sets, their classes, and the sketch pieces that different sets share.

    ``docs``: columns id and text. Documents with equal sets are one class from here on.
    """
    spark, kind = docs.sparkSession, docs.schema["id"].dataType.simpleString()
    digests = docs.mapInArrow(_digest(width), f"id {kind}, n long, fp long, fq long")
    digests = stored(digests, "digests")
    classes = digests.filter("n > 0").groupBy("fp").agg(F.min("id").alias("id"), F.min("n").alias("n"),
                                                        F.min("fq").alias("fq"), F.max("fq").alias("fq_max"))
    if classes.filter("fq <> fq_max").limit(1).count():
        raise RuntimeError("Two different sets share a 64-bit fingerprint.")

    # A key with one set tells nothing. What is left is small: pieces that different sets have in common.
    pieces = docs.select("text").mapInArrow(_emit_keys(width), "key long, fp long, tag int")
    per_key = Window.partitionBy("key")
    pieces = pieces.select("*", F.count(F.lit(1)).over(per_key).alias("rows"), F.min("fp").over(per_key).alias("lo"),
                           F.max("fp").over(per_key).alias("hi"))
    shared = stored(pieces.filter("lo <> hi").select("key", "fp", "tag", "rows").distinct(), "shared-pieces")
    # The most frequent pieces of a set go first, as many as it can spare.
    frequent = Window.partitionBy("fp", "tag").orderBy(F.desc("rows"), "key")
    kept = shared.withColumn("at", F.row_number().over(frequent)).filter("at > shiftright(tag, 1)").select("key", "fp").distinct()
    # How much of a set others have too: in a group of copies, the text they were made from comes first.
    common = shared.groupBy("fp").agg(F.sum(F.log2("rows")).alias("common"))
    kept = kept.join(classes.select("fp", "n", "id"), "fp").join(common, "fp").withColumn("common", F.col("common") / F.col("n"))
    deciding = stored(_with_others(kept, "fp").select("key", "fp", "n", "id", "common"), "deciding-pieces")
    remove_scratch(shared)

    needed = deciding.select("fp", "id").distinct()
    bit = F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS))
    words = needed.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).collect()  # BITMAP_BITS / 64 rows at most
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    for at, word in words:
        bitmap[at] = word
    sent = spark.sparkContext.broadcast(bitmap.tobytes())
    again = docs.filter("id is not null").select("id", "text", bit.alias("bit"))
    sets = again.mapInArrow(_needed_sets(width, sent), f"id {kind}, fp long, tokens binary, " + ", ".join(f"{s} long" for s in SHORT))
    sets = sets.join(needed, ["fp", "id"]).dropDuplicates(["fp"]).drop("id")
    return Sketches(digests, deciding.drop("id"), stored(sets, "sets"))


def _with_others(rows: DataFrame, label: str) -> DataFrame:
    """Rows of keys under which at least two labels stand."""
    mixed = rows.groupBy("key").agg(F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo <> hi")
    return rows.join(mixed, "key")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, united) of the pairs whose sets link, by the sets themselves."""
    full = pairs.join(sets.select(F.col("fp").alias("a"), F.col("tokens").alias("x")), "a")
    full = full.join(sets.select(F.col("fp").alias("b"), F.col("tokens").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(_compare, "a long, b long, common long, united long")


def _close_in_size(a: str, b: str) -> Column:
    return F.expr(f"{DENOMINATOR} * {a} >= {NUMERATOR} * {b} and {DENOMINATOR} * {b} >= {NUMERATOR} * {a}")


def _meetings(keys: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of sets in different groups (column ``part``) that meet under a key and may link by their short sketches."""
    rows = _with_others(keys, "part").join(sets.select("fp", *SHORT), "fp")
    left, right = (rows.select("key", F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("part").alias(f"p{x}"),
                               *[F.col(s).alias(f"{s}{x}") for s in SHORT]) for x in "ab")
    distance = " + ".join(f"bit_count({s}a ^ {s}b)" for s in SHORT)
    met = left.join(right, "key").filter("a < b and pa <> pb").filter(_close_in_size("na", "nb")).filter(
        f"{DENOMINATOR + NUMERATOR} * ({distance}) <= {DENOMINATOR - NUMERATOR} * (na + nb)")
    return met.select("a", "b").distinct()


def links(found: Sketches) -> DataFrame:
    """Every link between classes: (a, b, common, united), a and b fingerprints. The exhaustive join."""
    return verified(_meetings(found.keys.withColumn("part", F.col("fp")), found.sets), found.sets)


def groups(found: Sketches) -> DataFrame:
    """(node, component) of the classes, without listing the pairs inside a group.

    First each set is compared with one set of another group only, round after round while groups merge: of
    the sets that have most in common with all others under one of its keys, the one it meets most often.
    Then every pair that still stands in two groups and meets under a key is compared, which is the whole
    join but for pairs that are connected anyway.
    """
    keys, edges = found.keys, None
    parts = keys.withColumn("part", F.col("fp"))
    for _ in range(MERGE_ROUNDS):
        rows = _with_others(parts, "part")
        heads = rows.groupBy("key").agg(F.max_by(F.struct("fp", "n", "part"), F.struct("common", "fp")).alias("head"))
        met = rows.join(heads, "key").filter("part <> head.part").filter(_close_in_size("n", "head.n"))
        met = met.groupBy(F.col("fp").alias("a"), F.col("head.fp").alias("b")).agg(F.count(F.lit(1)).alias("times"))
        best = met.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b"))
        new = stored(verified(best, found.sets).select("a", "b"), "links")
        if new.isEmpty():
            break
        edges = stored(edges.unionByName(new), "links") if edges is not None else new
        parts = _labelled(keys, edges)
    rest = stored(verified(_meetings(parts, found.sets), found.sets).select("a", "b"), "links")
    return connected_components(rest if edges is None else edges.unionByName(rest))


def _labelled(keys: DataFrame, edges: DataFrame) -> DataFrame:
    labels = stored(connected_components(edges), "labels")
    return keys.join(labels, keys["fp"] == labels["node"], "left").select(
        "key", "fp", "n", "common", F.coalesce("component", "fp").alias("part"))


def _members(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, fp, label) of every row; label, the same throughout a group, is null for the empty set."""
    found = sketch(docs, width)
    labels = stored(groups(found), "groups")
    return found.digests.join(labels, found.digests["fp"] == labels["node"], "left").select(
        "id", "n", "fp", F.when(F.col("n") > 0, F.coalesce("component", "fp")).alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document is the set of its distinct
    ``width``-word shingles (with fewer words, its whole sequence; without words or with a null text, the empty
    set, which links with nothing). Sets link at a Jaccard similarity of 0.75 or more. Tokens are 64-bit
    hashes of shingles.

    Documents with equal sets are compared once. A text of any length is one row and its set; no task
    holds a group. Repeated rows are members of their group. Rows with a null id have a null component.
    Other columns are left out; an empty table gives an empty table.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    members = _members(docs, width)
    least = members.filter("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    # Rows without a label find nothing; their keys are spread, so that they do not meet in one task.
    spread = F.coalesce("label", F.xxhash64("id"))
    named = members.join(least.withColumnRenamed("label", "_group"), spread == F.col("_group"), "left")
    own = F.when(F.col("id").isNotNull(), F.when(F.col("label").isNotNull(), F.coalesce("least", "id")).otherwise(F.col("id")))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All columns of ``docs``, one row of each group: that with the smallest id (see ``near_duplicates``).

    Rows without words, and rows with a null id, all stay. Where an id is repeated, its rows are told apart
    by their sets; of equal ones a single row stays, any of them.
    """
    members = stored(_members(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), width), "members")
    first = members.filter("label is not null and id is not null").groupBy("label").agg(F.min(F.struct("id", "fp")).alias("first"))
    gone = members.filter("id is not null").join(first, "label").filter("id <> first.id or fp <> first.fp").select("id", "fp")
    gone = stored(gone.distinct(), "gone")
    repeated = stored(members.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "repeated")
    own = F.col(f"`{id_col}`")
    single = docs.join(gone.select("id").distinct(), own == gone["id"], "left_anti")
    if repeated.isEmpty():
        return single

    @F.arrow_udf("array<bigint>")
    def told(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            with np.errstate(over="ignore"):
                yield pa.array([[len(x), fingerprint(x)[0] if len(x) else 0] for x in sets_of_batch(column, width)], pa.list_(pa.int64()))

    single = single.join(repeated, own == repeated["id"], "left_anti")
    mark = unused_name(docs, "_pj")
    several = docs.join(repeated, own == repeated["id"], "left_semi").withColumn(mark, told(F.col(f"`{text_col}`")))
    empty = several.filter(F.col(mark)[0] == 0).drop(mark)
    several = several.filter(F.col(mark)[0] > 0).withColumn(mark, F.col(mark)[1])
    several = several.join(gone, (own == gone["id"]) & (F.col(mark) == gone["fp"]), "left_anti")
    return single.unionByName(empty).unionByName(several.dropDuplicates([id_col, mark]).drop(mark))
