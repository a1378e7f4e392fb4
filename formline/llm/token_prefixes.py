"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The last token of a prefix's encoding is the one piece that ends there and that may follow the last token of
the prefix before it. So one pass from left to right gives the count of every prefix, and what was stored once
answers any question about truncation or budgets without encoding again.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from operator import add, sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BLANK = "▁"  # stands for a space in pieces
LETTERS = "A-Za-z\u00c0-\u024f"
LETTER = re.compile(f"[{LETTERS}]")
# Words kept by a worker, in two generations, and the longest that is kept.
KEPT_WORDS, KEPT_LENGTH = 600_000, 64
KEPT_PAIRS = 1_000_000
# Texts are cut into words in stretches of about so many characters.
STRETCH = 1 << 20
RESULT = "struct<n_tokens:bigint,cut_chars:bigint,cut_tokens:bigint,steps:binary>"
_RESULT = pa.struct([("n_tokens", pa.int64()), ("cut_chars", pa.int64()), ("cut_tokens", pa.int64()), ("steps", pa.binary())])


class Memory(dict):
    """What ``make`` gives for a key, kept for up to twice ``size`` keys."""

    def __init__(self, make, size: int, keep=lambda key: True):
        super().__init__()
        self.make, self.size, self.keep, self.older = make, size, keep, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if self.keep(key):
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class PrefixCounter:
    """Token counts of all prefixes under a byte-pair model of sentencepiece with byte fallback.

    The model has to leave texts as they are but for spaces, of which it puts one in front; its pieces have to
    consist of characters that are pieces, with spaces at the front only. Any other model is refused.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = (model.is_byte, model.is_unused, model.is_control, model.is_unknown)
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids if not any(kind(i) for kind in special)}
        probe = "a  b ﬁＡé\t  "
        if (sum(map(model.is_byte, ids)) != 256 or any(map(model.is_unused, ids)) or model.normalize(probe) != BLANK + probe.replace(" ", BLANK)
                or any(c not in self.score for piece in self.score for c in piece) or any(BLANK in piece.lstrip(BLANK) for piece in self.score)):
            raise ValueError(f"Prefix counts need a byte-pair model with byte fallback and without normalisation: {path}")
        self.pieces = ["", *self.score]  # by number; 0 stands for no piece
        self.ends = ahocorasick.Automaton()  # finds the pieces that end at a place, the longest first
        for number, piece in enumerate(self.pieces[1:], 1):
            self.ends.add_word(piece, (number, len(piece)))
        self.ends.make_automaton()
        # Nothing joins across a control character that no piece holds, from a letter to a mark that no piece has
        # after a letter, and from anything to a space.
        controls = re.escape("".join(c for c in map(chr, range(0x20)) if c not in self.score)) or BLANK
        follow = {mark for piece in self.score for letter, mark in zip(piece, piece[1:]) if LETTER.match(letter)}
        self.marks = frozenset(".,;:!?") - follow
        marks = re.escape("".join(sorted(self.marks))) or BLANK
        self.plain = "\n" not in self.score
        self.words = re.compile(f"{BLANK}*[{LETTERS}]+(?=[{marks}])|{BLANK}*[^{BLANK}{controls}]+|{BLANK}+|[{controls}]")
        short = lambda word: len(word) <= KEPT_LENGTH
        self.follows = Memory(lambda pair: self._follows(self.pieces[pair >> 32], self.pieces[pair & 0xFFFFFFFF]), KEPT_PAIRS)
        self.total = Memory(self._total, KEPT_WORDS, short)
        self.written = Memory(lambda word: np.array(self.steps(word), np.int8).tobytes(), KEPT_WORDS, short)

    def _follows(self, before: str, piece: str) -> bool:
        """Whether the string of both is encoded as these two pieces; without the first, as the second alone.

        The best scored pair is joined first, of equal ones the leftmost.
        """
        parts, border, score = [*before, *piece], len(before), self.score
        while len(parts) > 1:
            found = [(-score[joined], i) for i, joined in enumerate(map(add, parts, parts[1:])) if joined in score]
            if not found:
                break
            at = min(found)[1]
            if at == border - 1:
                return False
            border -= at < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts == ([before, piece] if before else [piece])

    def _total(self, word: str) -> int:
        if word[-1:] in self.marks and LETTER.match(word[-2:-1]):
            return self.total[word[:-1]] + self.total[word[-1]]
        return self.prefixes(word)[-1]

    def prefixes(self, word: str) -> list[int]:
        """The counts of all prefixes of a stretch between two seams."""
        counts, lasts, follows, at = [0], [0], self.follows, 0
        for end, (piece, length) in self.ends.iter(word):
            if end < at:  # its piece is found
                continue
            while at < end:
                counts.append(counts[-1] + len(word[at].encode()))
                lasts.append(0)
                at += 1
            start = end + 1 - length
            if follows[lasts[start] << 32 | piece]:
                counts.append(counts[start] + 1)
                lasts.append(piece)
                at = end + 1
        while at < len(word):  # characters without a piece: their bytes, and nothing joins across them
            counts.append(counts[-1] + len(word[at].encode()))
            lasts.append(0)
            at += 1
        return counts

    def steps(self, word: str) -> list[int]:
        """By how much the count changes with each character."""
        counts = self.prefixes(word)
        return list(map(sub, counts[1:], counts))

    def stretches(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Stretches between seams and their length in all, some at a time; a space stands in front of a text that is not empty."""
        if 0 < len(text) <= STRETCH and self.plain and "  " not in text and BLANK not in text and text[0] != " ":
            yield (BLANK + text).replace(" ", " " + BLANK).replace("\n", " \n ").split(" "), len(text) + 1
            return
        text = (BLANK + text).replace(" ", BLANK) if text else ""
        at = 0
        while at < len(text):
            end = text.find(BLANK, at + STRETCH)
            while 0 < end and text[end - 1] == BLANK:  # not inside a run of spaces
                end = text.find(BLANK, end + 1)
            end = len(text) if end < 0 else end
            yield self.words.findall(text, at, end), end - at
            at = end

    def prefix_steps(self, text: str) -> bytes:
        """One signed byte per character: the change of the count. Their running sum is the count of every prefix."""
        found = b"".join(b"".join(map(self.written.__getitem__, words)) for words, _ in self.stretches(text))
        if not found:
            return b""
        steps = np.frombuffer(found, np.int8)[1:].copy()
        steps[0] += found[0]  # the space in front counts with the first character
        return steps.tobytes()

    def cut(self, text: str, limit: int) -> tuple[int, int, int]:
        """(tokens, characters, tokens of these): of the whole text, and of its longest prefix with at most ``limit`` tokens."""
        total = place = 0  # tokens and characters so far
        best = (0, 0)
        for words, length in self.stretches(text):
            counts = list(map(self.total.__getitem__, words))
            reached = total + sum(counts)
            if reached <= limit:
                best = (place + length, reached)
            elif total <= limit:  # counts at the ends of words only grow: the last word that begins within the limit decides
                before = list(accumulate(counts, initial=total))
                j = bisect_right(before, limit) - 1
                inside = list(accumulate(self.steps(words[j]), initial=before[j]))
                i = max(i for i, count in enumerate(inside) if count <= limit)
                best = (place + sum(map(len, words[:j])) + i, inside[i])
            place += length
            total = reached
        # The space in front is no character of the text, and the empty prefix has no token.
        return (total, best[0] - 1, best[1]) if best[0] > 1 else (total, 0, 0)


_COUNTERS: dict[str, PrefixCounter] = {}


def prefix_counter(path: str) -> PrefixCounter:
    """The one of this Python worker, which keeps what it learned from one task to the next."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_prefixes(docs: DataFrame, model: str, text_col: str = "text", limit: int = LIMIT, steps: bool = False) -> DataFrame:
    """``docs`` with a struct column ``tokens``: n_tokens, cut_chars, cut_tokens, steps.

    n_tokens: tokens of the whole text, without marks of beginning and end. cut_chars, cut_tokens: the longest
    prefix of at most ``limit`` tokens, in code points, and its tokens. steps (null unless asked for): the
    counts of all prefixes, one byte per code point, to be stored and asked by ``tokens_before`` and
    ``longest_prefix``. Every row is counted, repeated ones as well. A null or empty text has no token. Texts
    are read whole, in stretches. An empty table gives an empty table; a column named tokens is replaced.
    """

    @F.arrow_udf(RESULT)
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = prefix_counter(model)
        for column in texts:
            rows = []
            for text in column:
                text = text.as_py() or ""
                rows.append((*counter.cut(text, limit), counter.prefix_steps(text) if steps else None))
            yield pa.array([dict(zip(("n_tokens", "cut_chars", "cut_tokens", "steps"), row)) for row in rows], _RESULT)

    count = count.asNondeterministic()  # else every field that is used might count again
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "tokens"]
    return docs.select(*kept, count(F.col(f"`{text_col}`").cast("string")).alias("tokens"))


def _counts(steps: bytes) -> np.ndarray:
    """The count of every prefix, from the empty one on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def _tokens_before(steps: pa.Array, chars: pa.Array) -> pa.Array:
    found = []
    for row, n in zip(steps, chars):
        row, n = row.as_py(), n.as_py()
        found.append(None if row is None or n is None else int(np.frombuffer(row, np.int8, min(max(n, 0), len(row))).sum(dtype=np.int64)))
    return pa.array(found, pa.int64())


def _longest_prefix(steps: pa.Array, limits: pa.Array) -> pa.Array:
    found = []
    for row, limit in zip(steps, limits):
        row, limit = row.as_py(), limit.as_py()
        if row is None or limit is None or limit < 0:
            found.append(None)
            continue
        counts = _counts(row)
        at = int(np.flatnonzero(counts <= limit)[-1])
        found.append({"chars": at, "tokens": int(counts[at])})
    return pa.array(found, pa.struct([("chars", pa.int64()), ("tokens", pa.int64())]))


def tokens_before(steps: Column | str, chars: Column) -> Column:
    """Tokens of a text's first ``chars`` code points, from its stored steps; beyond the end, of the whole text."""
    return F.arrow_udf(_tokens_before, "bigint")(steps, chars.cast("long"))


def longest_prefix(steps: Column | str, limit: Column) -> Column:
    """(chars, tokens) of the longest prefix with at most ``limit`` tokens, from the stored steps; null for a negative limit."""
    return F.arrow_udf(_longest_prefix, "struct<chars:bigint,tokens:bigint>")(steps, limit.cast("long"))


def common_limit(counts: Column | str, docs: DataFrame, budget: int, width: int = 32) -> int | None:
    """The largest limit per document under which all documents together keep at most ``budget`` tokens.

    None if no limit is needed; rows without a count count nothing. Each pass over the counts narrows the range by ``width``.
    """
    counts = F.col(counts) if isinstance(counts, str) else counts
    docs = docs.filter(counts.isNotNull())
    total, low, high = docs.agg(F.sum(counts), F.lit(0), F.max(counts)).first()
    if total is None or total <= budget:
        return None
    while high - low > 1:  # the sum fits at low and not at high
        tries = sorted({low + max(1, (high - low) * i // width) for i in range(1, width)} - {high})
        sums = docs.agg(*[F.sum(F.least(counts, F.lit(t))) for t in tries]).first()
        low = max([low, *[t for t, s in zip(tries, sums) if s <= budget]])
        high = min([high, *[t for t, s in zip(tries, sums) if s > budget]])
    return low
