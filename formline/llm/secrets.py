"""Secrets in texts: fixed patterns, and strings in sensitive places that zstandard cannot compress."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from formline.operators.layout import remove_scratch, stored, unused_name

KINDS = ("assign", "access", "hex", "novel")
# Fixed patterns, ASCII letters only: keyword, separator, value; access key; run of hexadecimal digits.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# A place is sensitive if one of these words stands at most REACH characters before the string.
SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|authorization|bearer|akia", re.IGNORECASE | re.ASCII)
REACH = 48
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~$!@#%^&*.-]{12,}")
# The text around a candidate that primes the compressor.
AROUND = 256
# Marginal bytes per character from which a string counts as incompressible. Letters alone have to cost so
# many bytes as well: a shorter unknown word of a language costs no less than a random one.
NOVELTY, PLAIN_BYTES = 0.62, 24
# Each dictionary's size, the words it is made of, and how many texts have to hold a word. Words are shorter
# than any candidate and stand apart by a blank, so no candidate is in what primes its own measure.
DICTIONARY_BYTES, DICTIONARY_TEXTS = 32_768, 5
WORDS = {
    "code": re.compile(r"(?<![A-Za-z0-9_.])[A-Za-z_.]{1,8}[()\[\]{}=;<>/&|]{1,3}|[()\[\]{}=;<>/&|]{2,3}"),
    "identifiers": re.compile(r"[A-Z][a-z]{3,10}(?![a-z])|(?<![A-Za-z])[a-z]{4,11}(?![a-z])|(?<![A-Z])[A-Z]{4,11}(?![A-Za-z])")}
# Words that a task counts before it passes them on.
COUNTED_WORDS = 200_000
# A string is known, not somebody's secret, if it stands in sensitive places of at least this share of the
# distinct texts, and of so many. The share bounds the known strings whatever the size of the corpus.
KNOWN_SHARE, KNOWN_TEXTS = 0.5, 5

SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
SCANNED = StructType([StructField("spans", ArrayType(SPAN)), StructField("clean", StringType())])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' matches, leftmost without overlap per kind; too short ones are dropped."""
    found = []
    low = text.lower() if not text.isascii() else text.casefold()
    if any(word in low for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Long strings without white space that a sensitive word precedes closely."""
    found, last, held, sign = {}, 0, 0, -1
    for word in SENSITIVE.finditer(text):
        at, stop = max(word.start(), last), word.end() + REACH
        while m := CANDIDATE.search(text, at, min(len(text), stop + 12)):
            start, end = m.start(), m.end()
            if start < held:
                end = held
            elif end == stop + 12:  # the window may have cut it
                end = held = CHARACTERS.match(text, end).end()
            at = end
            # What stands before a separator is the name, what follows it the value.
            if start < word.end():
                if sign < word.end():
                    sign = text.find("=", word.end(), end)
                    sign = end if sign < 0 else sign
                start = sign + 1
            elif head := NAME.match(text, start, end):
                start = head.end()
            if end - start >= 12:
                found[start] = last = end
    return sorted(found.items())


CHARACTERS = re.compile(r"[A-Za-z0-9+/_=~$!@#%^&*.-]*")
PUNCTUATION = "+/_=~$!@#%^&*.-"
NAME = re.compile(r"[A-Za-z_.-]*[=:](?=.{12})")


@dataclass(frozen=True)
class Knowledge:
    """What a scan knows of the corpus before it starts: strings known to all, and two dictionaries."""

    known: frozenset[bytes] = frozenset()
    code: bytes = b""
    identifiers: bytes = b""


class Novelty:
    """Marginal compressed size of a string after the dictionaries and its surroundings."""

    def __init__(self, knowledge: Knowledge = Knowledge()):
        import zstandard

        primed = knowledge.code + b" " + knowledge.identifiers
        parameters = zstandard.ZstdCompressionParameters.from_level(6, write_content_size=False, write_checksum=False, write_dict_id=False)
        content = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(primed) > 8 else None
        self.compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=content)

    def marginal_bytes(self, text: str, start: int, end: int) -> int:
        # Other occurrences of the string, with or without punctuation at its ends, say nothing about it.
        core, wide = text[start:end].strip(PUNCTUATION) or text[start:end], AROUND + end - start
        before = text[max(0, start - wide) : start].replace(core, " " * len(core))[-AROUND:]
        after = text[end : end + wide].replace(core, " " * len(core))[:AROUND]
        around = (before + "\n" + after + "\n").encode()
        return len(self.compressor.compress(around + text[start:end].encode())) - len(self.compressor.compress(around))


def digest(string: str) -> bytes:
    return hashlib.blake2b(string.encode(), digest_size=16).digest()


def novel_spans(text: str, novelty: Novelty, taken: list[tuple[str, int, int]], known: frozenset[bytes] = frozenset()) -> list[tuple[str, int, int]]:
    """Incompressible strings in sensitive places that no fixed pattern covers and that are not known.

    ``taken`` is in order of start, as the candidates are: both are walked once.
    """
    found, at, reached = [], 0, 0
    for start, end in candidates(text):
        while at < len(taken) and taken[at][1] <= start:
            reached = max(reached, taken[at][2])
            at += 1
        if end <= reached:
            continue
        string = text[start:end]
        if digest(string) in known:
            continue
        cost = novelty.marginal_bytes(text, start, end)
        if cost >= NOVELTY * len(string) and (cost >= PLAIN_BYTES or not string.isalpha()):
            found.append(("novel", start, end))
    return found


def outside(text: str) -> str:
    """The text without its sensitive places: from each sensitive word on up to REACH characters and the string there."""
    parts, at = [], 0
    for word in SENSITIVE.finditer(text):
        if word.start() >= at:
            parts.append(text[at : word.start()])
        at = max(at, CHARACTERS.match(text, min(len(text), word.end() + REACH)).end())
    return " ".join([*parts, text[at:]])


LEARNED = "text binary, string binary, dictionary string, word string, texts long"


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of every text and of the strings in its sensitive places (one row without a string per text); and words outside."""
    counts = {name: Counter() for name in WORDS}

    def words() -> pa.RecordBatch:
        rows = [(name, word, n) for name, found in counts.items() for word, n in found.items()]
        for found in counts.values():
            found.clear()
        none = pa.nulls(len(rows), pa.binary())
        return pa.RecordBatch.from_arrays([none, none, *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))]], names)

    names = ["text", "string", "dictionary", "word", "texts"]
    for batch in batches:
        texts, strings = [], []
        for text in batch.column(0):
            text = text.as_py()
            if not text:
                continue
            sensitive = SENSITIVE.search(text)
            held = [None, *{digest(text[a:b]) for a, b in candidates(text)}] if sensitive else [None]
            texts += [digest(text)] * len(held)
            strings += held
            plain = outside(text) if sensitive else text
            for name, pattern in WORDS.items():
                counts[name].update(set(pattern.findall(plain)))
            if sum(map(len, counts.values())) > COUNTED_WORDS:
                yield words()
        n = len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(strings, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()),
                                          pa.nulls(n, pa.int64())], names)
    yield words()


def learn(docs: DataFrame, text_col: str = "text") -> Knowledge:
    """Strings that everyone holds, and the two dictionaries, from one pass over all texts.

    Known are the strings that stand in sensitive places of KNOWN_SHARE of the distinct texts. Whole strings
    are compared, and copies of a text count once. As a text counts once per string, at most the mean
    number of strings a text divided by the share can be known; that many digests reach the driver.

    The dictionaries hold the words outside sensitive places that save most: texts that hold a word times its
    length, the best at the end. Their size is DICTIONARY_BYTES whatever the corpus; counts are exact.
    """
    found = stored(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(_learned, LEARNED), "learned")
    places = found.filter("text is not null").select("text", "string").distinct()
    counts = stored(places.groupBy("string").agg(F.count(F.lit(1)).alias("texts")), "strings")
    texts = counts.filter(F.col("string").isNull()).agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    needed = max(KNOWN_TEXTS, math.ceil(KNOWN_SHARE * texts))
    known = frozenset(bytes(r["string"]) for r in counts.filter(F.col("string").isNotNull() & (F.col("texts") >= needed)).select("string").collect())
    words = found.filter("word is not null").groupBy("dictionary", "word").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= DICTIONARY_TEXTS)
    best = [F.desc(F.col("texts") * F.length("word")), F.asc("word")]
    written = {}
    for name in WORDS:
        chosen, size = [], 0
        # Stored first: a task picks the best, and the driver gets no more than these.
        top = stored(words.filter(F.col("dictionary") == name).orderBy(*best).limit(DICTIONARY_BYTES // 3), "dictionary")
        for row in top.orderBy(*best).select("word").collect():
            size += len(row["word"]) + 1
            if size > DICTIONARY_BYTES:
                break
            chosen.append(row["word"])
        written[name] = " ".join(reversed(chosen)).encode()
    remove_scratch(found)
    remove_scratch(counts)
    return Knowledge(known, **written)


def secret_spans(docs: DataFrame, text_col: str = "text", knowledge: Knowledge | None = None, mark: str | None = None) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (kind, start, end), code points, end exclusive, by start and kind.

    With a ``mark`` the text is returned with every span replaced by it; spans that touch or overlap become one mark.

    Kinds assign, access and hex are the fixed patterns; ``novel`` are strings of 12 characters or more that
    follow a sensitive word closely and take at least NOVELTY compressed bytes per character beside their
    surroundings and dictionaries of the corpus, unless half of the distinct texts hold the same string there.
    Texts are scanned whole, in time linear in their length. Repeated rows each get their spans. A null or empty
    text has no span; an empty table gives an empty table; a column named secret_spans is replaced.
    """
    knowledge = learn(docs, text_col) if knowledge is None else knowledge
    scanned_name = unused_name(docs, "_scanned")

    @F.pandas_udf(SCANNED)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(knowledge)
        for batch in texts:
            found, clean = [], []
            for text in batch:
                spans = base_spans(text) if text else []
                if text and SENSITIVE.search(text):
                    spans = in_order(spans + novel_spans(text, novelty, spans, knowledge.known))
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                clean.append(redacted(text, spans, mark) if spans and mark is not None else None)
            yield pd.DataFrame({"spans": pd.Series(found, dtype=object), "clean": pd.Series(clean, dtype=object)})

    scan = scan.asNondeterministic()  # else every use of the spans might compute them again
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "secret_spans"]
    scanned = docs.select(*kept, scan(F.col(f"`{text_col}`")).alias(scanned_name))
    text = F.coalesce(f"{scanned_name}.clean", F.col(f"`{text_col}`")).alias(text_col)
    shown = [text if c == text_col and mark is not None else F.col(f"`{c}`") for c in docs.columns if c != "secret_spans"]
    return scanned.select(*shown, F.col(f"{scanned_name}.spans").alias("secret_spans"))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, at = [], 0
    for start, end in sorted((a, b) for _, a, b in spans):
        if start > at or not parts:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def joined(spans: Column | str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
