"""Language identification: known words first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Letters of any script; case folding is lower().
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
# Bound of the fitting sample: about this many documents of each language, drawn by a hash of the id.
FIT_DOCS = 2_500
# Words and n-grams seen less often in the sample of a language are left to shorter n-grams.
MIN_WORD, MIN_GRAM = 3, 3
ORDERS = (4, 3, 2, 1)
SMOOTH = 0.5
# Longer runs of letters are not words: the model does not learn them, n-grams score them.
LONGEST = 60
# Languages the model tells apart at most have to fit the driver; so many is far beyond any corpus.
CACHE_WORDS = 100_000

PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def grams(word: str, order: int) -> list[str]:
    marked = f"\x02{word}\x03"
    return [marked[i : i + order] for i in range(len(marked) - order + 1)] if order > 1 else list(word)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram_order, piece, times); order 0 is the whole word."""
    words: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, found in words.items():
            pieces = {0: found, **{order: Counter() for order in ORDERS}}
            for word, n in found.items():
                for order in ORDERS:
                    counts = pieces[order]
                    for gram in grams(word, order):
                        counts[gram] += n
            for order, counts in pieces.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array([order] * len(counts), pa.int32()),
                     pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "gram_order", "piece", "times"])
        words.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words.setdefault(lang, Counter()).update(w for w in LETTERS.findall(text.as_py().lower()) if len(w) <= LONGEST)
        if sum(map(len, words.values())) > 300_000:
            yield from rows()
    yield from rows()


class Model:
    """Per-language log frequencies of words and n-grams."""

    def __init__(self, languages: list[str], pieces: dict[tuple[int, str], np.ndarray]):
        self.languages = languages
        totals: dict[int, np.ndarray] = {}
        sizes: Counter = Counter()
        for (order, _), counts in pieces.items():
            totals[order] = totals.get(order, np.zeros(len(languages))) + counts
            sizes[order] += 1
        table = np.zeros((len(pieces), len(languages)), np.float32)
        self.words: dict[str, int] = {}
        self.grams: dict[int, dict[str, int]] = {order: {} for order in ORDERS}
        for at, ((order, piece), counts) in enumerate(pieces.items()):
            table[at] = np.log((counts + SMOOTH) / (totals[order] + SMOOTH * (sizes[order] + 1)))
            (self.grams[order] if order else self.words)[piece] = at
        self.table = table


class Scorer:
    """A model with a bounded memory for unseen words."""

    def __init__(self, model: Model):
        self.model = model
        self.seen = dict(model.words)
        self.known = len(model.table)
        self.extra = np.zeros((CACHE_WORDS, len(model.languages)), np.float32)
        self.used = 0

    def unseen(self, word: str) -> int:
        """The row of a word that the model has no count of: mean log frequency over its longest known n-grams.

        -1 if no n-gram is known: the word says nothing.
        """
        for order in ORDERS:
            table = self.model.grams[order]
            rows = [r for r in map(table.get, grams(word, order)) if r is not None]
            if rows:
                if self.used == CACHE_WORDS:
                    self.seen, self.used = dict(self.model.words), 0
                self.extra[self.used] = np.add.reduce(self.model.table[rows]) / len(rows)
                self.seen[word] = self.known + self.used
                self.used += 1
                return self.known + self.used - 1
        return -1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        for at in range(0, len(words), 20_000):  # bounds the arrays of a very long text
            part = words[at : at + 20_000]
            rows = np.fromiter(map(self.seen.get, part, repeat(-1)), np.int64, len(part))
            missing = np.flatnonzero(rows < 0)
            old = rows[(rows >= 0) & (rows < self.known)]
            total += self.model.table[old].sum(axis=0, dtype=np.float64)
            fresh = rows[rows >= self.known]
            total += self.extra[fresh - self.known].sum(axis=0, dtype=np.float64)
            for j in missing.tolist():
                row = self.seen.get(part[j], -1)
                row = self.unseen(part[j]) if row < 0 else row
                if row >= 0:
                    total += self.extra[row - self.known]
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_docs: int = FIT_DOCS) -> Model:
    """Counts words and n-grams of the labelled documents that are not held out.

    The sample is bounded: about ``fit_docs`` documents per language, by a hash of the id. The model that
    reaches the driver is bounded by it: pieces seen fewer than 3 times are not kept.
    """
    labelled = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model([], {})
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, fit_docs / n))])
    draw = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(draw < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_counts, "lang string, gram_order int, piece string, times long")
    counted = counted.groupBy("lang", "gram_order", "piece").agg(F.sum("times").alias("times"))
    counted = counted.filter(F.col("times") >= F.when(F.col("gram_order") == 0, MIN_WORD).otherwise(MIN_GRAM))
    languages, pieces = sorted(sizes), {}
    place = {lang: j for j, lang in enumerate(languages)}
    for lang, order, piece, times in counted.toLocalIterator():
        pieces.setdefault((order, piece), np.zeros(len(languages), np.float32))[place[lang]] = times
    return Model(languages, dict(sorted(pieces.items())))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the best language in the likelihood.

    Known words count with their log frequency per language; an unseen word with the mean of its longest
    known character n-grams. A text that is null or has no letter is ``und`` with score 0, and so is
    everything if the model has no language. Texts are read whole; columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for batch in texts:
            yield pd.DataFrame([scorer.predict(t) for t in batch], columns=["lang_pred", "score"])

    scores = scores.asNondeterministic()  # else a filter on the prediction would compute it a second time
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "_prediction")]
    return docs.select(*kept, scores(F.col(f"`{text_col}`")).alias("_prediction")).select(
        *kept, "_prediction.lang_pred", "_prediction.score")
