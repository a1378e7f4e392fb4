"""Phrases that stand together more often than their parts tell, counted in quotient filters.

Texts become blocks of word numbers. A word's number is its place in the table of all words that are frequent
enough. Then for two, three and four words: every block counts its n-grams in a filter, the filters of a
bucket are merged in one place, and each block hears which of its n-grams are frequent. Only where all shorter
n-grams are frequent can a longer one be, so what is counted next shrinks, and no frequent phrase is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.quotient_filter import Layout
from formline.operators.layout import numbered, remove_scratch, stored

LEAST, LONGEST, TOP = 30, 4, 2_000
UNKNOWN = "und"
# Words of a block, and distinct n-grams that a bucket is meant to hold.
BLOCK_WORDS, BUCKET_GRAMS = 1 << 19, 1 << 19
# Texts are cut into words in stretches of about so many bytes.
STRETCH = 1 << 22
END = b"\xff"  # no text holds this byte: the end of a piece
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
for _mark in b".,;:!?\n\v\f\r":
    _TABLE[_mark] = END[0]
_TABLE[0x09] = 0x20
TABLE = bytes(_TABLE)

BLOCK = "block long, ids binary, words array<struct<lang:string,word:string,n:bigint>>, totals array<struct<lang:string,n:bigint>>"
_BLOCK = pa.schema([
    ("block", pa.int64()), ("ids", pa.binary()),
    ("words", pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))),
    ("totals", pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())])))])
RUNS = "block long, ids binary, grams long"
SLICE = "bucket int, block long, size int, runs binary, lefts binary, rights binary, counts binary"
MERGED = "block long, bucket int, mask binary, words array<bigint>, times bigint"


class Numbers(dict):
    """Numbers for the words of one language, from a count shared by all languages of a block."""

    def __init__(self, names: list, lang: str):
        super().__init__({END: 0})
        self.names, self.lang = names, lang

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = len(self.names)
        return len(self.names)


def stretches(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text and the ends of its pieces, some at a time, cut at the end of a piece where there is one."""
    data = data.translate(TABLE)
    at = 0
    while at < len(data):
        end = data.find(END, at + STRETCH) + 1 if at + STRETCH < len(data) else 0
        end = end or len(data)
        yield data[at:end].replace(END, b" \xff ").split()
        at = end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole pieces; a block is longer than BLOCK_WORDS only by the stretch that ends it."""
    made, names, numbers, parts, size = 0, [], {}, [], 0
    task = TaskContext.get().partitionId() << 32

    def block() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        times = np.bincount(ids, minlength=len(names) + 1)[1:].tolist()
        totals: dict[str, int] = {}
        for (lang, _), n in zip(names, times):
            totals[lang] = totals.get(lang, 0) + n
        words = [{"lang": lang, "word": word.decode("utf-8", "replace"), "n": n} for (lang, word), n in zip(names, times)]
        return pa.RecordBatch.from_pylist([{
            "block": task + made, "ids": ids.astype("<i4").tobytes(), "words": words,
            "totals": [{"lang": lang, "n": n} for lang, n in totals.items()]}], _BLOCK)

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_py()
            if not text:
                continue
            known = numbers.setdefault(lang, Numbers(names, lang))
            for words in stretches(text):
                parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                parts.append(np.zeros(1, np.int64))
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield block()
                    made, size = made + 1, 0
                    names, numbers, parts = [], {}, []
                    known = numbers.setdefault(lang, Numbers(names, lang))
    if parts:
        yield block()


def _runs(alive: np.ndarray, ids: np.ndarray, words: int) -> np.ndarray:
    """Runs of ids in which an n-gram of ``words`` ids begins at every living place; those with one such place go."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], alive.astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    keep = ends - starts > 1
    starts, lengths = starts[keep], (ends - starts)[keep] + words - 1
    if not len(starts):
        return np.zeros(0, ids.dtype)
    total = lengths + 1  # a zero ends each run
    begin = np.cumsum(total) - total
    at = np.arange(total.sum()) - np.repeat(begin, total) + np.repeat(starts, total)
    found = ids[np.minimum(at, len(ids) - 1)]
    found[begin + lengths] = 0
    return found


def _grams(ids: np.ndarray, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where n-grams begin, and their ids; none goes over a zero."""
    n = max(0, len(ids) - words + 1)
    whole = np.ones(n, bool)
    for i in range(words):
        whole &= ids[i : i + n] != 0
    starts = np.flatnonzero(whole)
    return starts, [ids[starts + i] for i in range(words)]


def _row(block: int, ids: np.ndarray, words: int) -> pa.RecordBatch:
    grams = len(_grams(ids, words)[0])
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([ids.astype("<u4").tobytes()], pa.binary()),
                                       pa.array([grams], pa.int64())], ["block", "ids", "grams"])


def _translated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in numbers of the vocabulary; other words end a run, and words between two such go."""
    for batch in batches:
        for block, ids, places, numbers in zip(*(batch.column(i) for i in range(4))):
            ids = np.frombuffer(ids.as_py(), "<i4")
            number = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
            number[places.values.to_numpy() + 1] = numbers.values.to_numpy()
            ids = number[ids]
            yield _row(block.as_py(), _runs(ids != 0, ids, 1), 2)


def _filters(layout: Layout, bucket_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("size", pa.int32()), *[(n, pa.binary()) for n in ("runs", "lefts", "rights", "counts")]])
        for batch in batches:
            for block, ids in zip(batch.column(0), batch.column(1)):
                _, grams = _grams(np.frombuffer(ids.as_py(), "<u4"), layout.words)
                left, right, counts, _ = layout.counted(*layout.permuted(grams))
                bounds = _bucket_bounds(layout.bucket(left, bucket_bits))
                yield pa.RecordBatch.from_pylist([
                    {"bucket": bucket, "block": block.as_py(), **layout.written(left[a:b], right[a:b], counts[a:b], bucket_bits)}
                    for bucket, a, b in bounds], schema)

    return run


def _bucket_bounds(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of each bucket in a sorted array."""
    starts = np.flatnonzero(np.diff(buckets, prepend=-1)) if len(buckets) else np.zeros(0, np.int64)
    return list(zip(buckets[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(buckets)]))


def _merge(layout: Layout, bucket_bits: int, least: int):
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("mask", pa.binary()), ("words", pa.list_(pa.int64())), ("times", pa.int64())])

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
        slices: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if slices and slices[0]["bucket"] != row["bucket"]:
                    yield slices[0]["bucket"], slices
                    slices = []
                slices.append(row)
        if slices:
            yield slices[0]["bucket"], slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, slices in buckets(batches):
            parts = [layout.read(row, bucket, bucket_bits) for row in slices]
            left, right, counts, place = layout.counted(*[np.concatenate(columns) for columns in zip(*parts)])
            frequent = counts >= least
            told = frequent[place]
            bounds = np.cumsum([0, *[row["size"] for row in slices]])
            yield pa.RecordBatch.from_pylist([
                {"block": row["block"], "bucket": bucket, "mask": np.packbits(told[a:b]).tobytes()}
                for row, a, b in zip(slices, bounds[:-1], bounds[1:])], schema)
            ids = np.stack(layout.restored(left[frequent], right[frequent]), 1).astype(np.int64)
            n = len(ids)
            words = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * layout.words, pa.int32()), pa.array(ids.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), words,
                                              pa.array(counts[frequent], pa.int64())], schema=schema)

    return run


def _pruned(layout: Layout, bucket_bits: int):
    """Runs in which every n-gram is frequent, from the answers to the block's filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, masks in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                ids = np.frombuffer(ids.as_py(), "<u4")
                starts, grams = _grams(ids, layout.words)
                left, _, _, place = layout.counted(*layout.permuted(grams))
                answer = {row["bucket"]: row["mask"] for row in masks}
                frequent = np.zeros(len(left), bool)
                for bucket, a, b in _bucket_bounds(layout.bucket(left, bucket_bits)):
                    frequent[a:b] = np.unpackbits(np.frombuffer(answer[bucket], np.uint8), count=b - a)
                alive = np.zeros(len(ids), bool)
                alive[starts] = frequent[place]
                yield _row(block.as_py(), _runs(alive, ids, layout.words), layout.words + 1)

    return run


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vocabulary, phrases, totals): what occurs at least ``least`` times in a language.

    vocabulary: lang, word, times, number (from 1). phrases: words (array of 2 to ``longest`` numbers) and times.
    totals: lang and n, all its word occurrences. Counts are exact.
    """
    rows = docs.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    blocks = stored(rows.mapInArrow(_blocks, BLOCK), "blocks")
    totals = stored(blocks.select(F.explode("totals").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("n")), "totals")
    words = blocks.select("block", F.posexplode("words").alias("place", "w")).select("block", "place", "w.lang", "w.word", "w.n")
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("times")).filter(F.col("times") >= least)
    vocabulary, size = numbered(frequent, "number", first=1)
    names = words.select("block", "place", "lang", "word").join(vocabulary.select("lang", "word", "number"), ["lang", "word"]) \
        .groupBy("block").agg(F.collect_list(F.struct("place", "number")).alias("found"))
    told = blocks.select("block", "ids").join(names, "block").select("block", "ids", "found.place", "found.number")
    runs = stored(told.mapInArrow(_translated, RUNS), "runs")
    remove_scratch(blocks)
    phrases = docs.sparkSession.createDataFrame([], "words array<bigint>, times bigint")
    for length in range(2, longest + 1):
        grams = runs.agg(F.sum("grams")).first()[0] or 0
        if not grams:
            break
        layout = Layout(length, max(1, size.bit_length()))
        bucket_bits = min(layout.left_bits, 30, max(0, math.ceil(math.log2(grams / BUCKET_GRAMS))))
        slices = runs.mapInArrow(_filters(layout, bucket_bits), SLICE)
        merged = stored(slices.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(layout, bucket_bits, least), MERGED), f"grams-{length}")
        phrases = phrases.unionByName(merged.filter("times is not null").select("words", "times"))
        before = runs
        if length < longest:
            masks = merged.filter("mask is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))
            runs = stored(runs.join(masks, "block").select("block", "ids", "masks").mapInArrow(_pruned(layout, bucket_bits), RUNS), "runs")
        remove_scratch(before)
    return vocabulary, phrases, totals


def _exact(column: Column | str) -> Column:
    """A count as a decimal: products of such do not overflow."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def scored_phrases(vocabulary: DataFrame, phrases: DataFrame) -> DataFrame:
    """(words, a, l, r, score, longer) of every phrase: the lowest scoring cut, and the most frequent longer phrase around it."""
    counts = phrases.unionByName(vocabulary.select(F.array("number").alias("words"), "times"))
    cuts = phrases.select("words", F.col("times").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("cut"))
    cuts = cuts.withColumns({"head": F.expr("slice(words, 1, cut)"), "rest": F.expr("slice(words, cut + 1, size(words) - cut)")})
    parted = cuts.join(counts.select(F.col("words").alias("head"), F.col("times").alias("l")), "head") \
        .join(counts.select(F.col("words").alias("rest"), F.col("times").alias("r")), "rest")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = parted.withColumn("score", score).groupBy("words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), n -> transform(sequence(1, size(words) - n + 1), i -> slice(words, i, n))))")
    around = phrases.filter("size(words) > 2").select(F.explode(inner).alias("words"), "times").groupBy("words").agg(F.max("times").alias("longer"))
    return best.join(around, "words", "left").select("words", "a", "best.l", "best.r", "best.score", "longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of 2 to ``longest`` words that occur ``least`` times or more.

    Texts are lower-cased (A-Z), cut at . , ; : ! ? and line ends into pieces, and those at blanks and tabs into
    words; phrases stay inside pieces, and every language is by itself (null: ``und``). a, l, r: occurrences
    of the phrase, of its first part and of the rest; n: word occurrences of the language. score =
    floor(2000000 a / (l + r)) at the cut where it is lowest, the first of equal ones. A phrase inside a longer one that
    has at least 80 % of its occurrences is left out. Order: score, a (descending), phrase by its bytes; ``top``
    rows a language, or all for None. Repeated rows count as often as they occur; null, empty texts and an
    empty table have no phrase; texts are read whole; further columns play no part.
    """
    vocabulary, phrases, totals = frequent_phrases(docs, text_col, lang_col, least, longest)
    scored = scored_phrases(vocabulary, phrases)
    kept = scored.filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * 80)).drop("longer")
    spelt = kept.select("words", F.posexplode("words").alias("place", "number")) \
        .join(vocabulary.select("number", "lang", "word"), "number") \
        .groupBy("words").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelt"))
    named = kept.join(spelt, "words").join(totals, "lang").select(
        "lang", F.array_join(F.transform("spelt", lambda s: s["word"]), " ").alias("phrase"), "a", "l", "r", "n", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # every language in several tasks first
        shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        named = named.withColumn("_place", F.row_number().over(share)).filter(F.col("_place") <= top).drop("_place")
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    shown = named if top is None else named.filter(F.col("rank") <= top)
    return shown.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
