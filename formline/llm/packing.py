"""Packing documents into training sequences: best-fit decreasing per partition, certified by lower bounds."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.texts import LOWER, NOT_SPACE, SLICE_BYTES, SPACE_BYTES, chunks, same_bytes, slices, text_bytes, word_hashes
from formline.operators.layout import stored

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Pieces that one task packs; a piece is a few numbers.
GROUP_PIECES = 20_000
ROUNDS = 3
# A worker forgets its pieces once they have so many token ids; a piece has three or four.
CACHE_IDS = 1 << 20


# Kinds of bytes: pieces are runs of one kind, single digits, or whole words with anything else in them.
_SPACE, _LETTER, _MARK, _DIGIT, _ELSE = 0, 1, 2, 3, 4
_KIND = np.full(256, _ELSE, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x27] = _ELSE  # the apostrophe joins letters
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:0xC0] = _KIND[0xC3] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[SPACE_BYTES] = _SPACE
# Byte-level vocabularies write a byte as a printable character: itself, or the next one from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def cut_pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in lower case, start and end of each piece, and whether it needs the whole tokenizer.

    The tokenizer drops white space and joins nothing across it. Within a word it takes runs of letters,
    single digits and runs of other marks by themselves, and all letters in lower case. Here the letters are
    those of ASCII and of U+00C0 to U+00FF; a word with anything else, or an apostrophe, stays whole.
    """
    kind, data = _KIND[data], LOWER[data]
    before = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
    following = (data >= 0x80) & (data < 0xC0)
    led = following & (before == 0xC3)
    odd = (kind == _ELSE) | (following & ~led) | (led & ((data == 0x97) | (data == 0xB7)))
    data = data + (led & (data < 0x9F) & (data != 0x97)) * np.uint8(0x20)
    inside = kind != _SPACE
    previous = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    previous[bounds[:-1][bounds[:-1] < len(data)]] = _SPACE
    first = inside & (previous == _SPACE)  # of a word
    word = np.cumsum(first) - 1
    whole = np.zeros(int(first.sum()) + 1, bool)
    whole[word[odd]] = True
    starts = np.flatnonzero(first | (inside & ((kind != previous) | (kind == _DIGIT)) & ~whole[word]))
    after = np.concatenate([inside[1:], np.zeros(1, bool)])
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    last = np.flatnonzero(inside & ~after) + 1  # ends of words
    ends = np.minimum(np.append(starts[1:], len(data)), last[word[starts]]) if len(starts) else starts
    return data, starts, ends, whole[word[starts]]


def distinct_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first occurrence of each distinct piece, and for every piece the number of its like.

    Hashes group the pieces, and their bytes are compared; should two pieces share a hash, the bytes group them.
    """
    with np.errstate(over="ignore"):
        _, first, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    like = first[inverse]
    if (ends - starts == ends[like] - starts[like]).all() and same_bytes(data, starts, ends, starts[like]):
        return first, inverse
    text, number = data.tobytes(), {}
    inverse = np.array([number.setdefault(text[a:b], len(number)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
    return np.unique(inverse, return_index=True)[1], inverse


class WordTokens:
    """Token ids of whole texts, tokenising each distinct piece of a word once.

    Pieces of letters, digits or marks go straight to the tokenizer's model, many at once; words that hold
    anything else go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # whether a token ends a piece
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.begin, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _learn(self, pieces: list[bytes], plain: np.ndarray) -> None:
        simple = [piece for piece, easy in zip(pieces, plain) if easy]
        other = [piece.decode() for piece, easy in zip(pieces, plain) if not easy]
        ids, sizes = [np.zeros(0, np.uint32)], np.zeros(len(pieces), np.int64)
        if simple:
            written = [p.decode() if p.isascii() else p.decode("latin-1").translate(_WRITTEN) for p in simple]
            lines = [" ".join(written[a : a + 1_000]) for a in range(0, len(written), 1_000)]
            ids.append(np.concatenate([np.array(x.ids, np.uint32) for x in self.model.encode_batch_fast(lines, add_special_tokens=False)]))
            sizes[: len(simple)] = np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1)
        if other:
            found = [x.ids for x in self.tokenizer.encode_batch(other, add_special_tokens=False)]
            ids.append(np.array([i for x in found for i in x], np.uint32))
            sizes[len(simple) :] = [len(x) for x in found]
        flat, n = np.concatenate(ids), len(self.place)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + 1 + len(pieces) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.begin[n + 1 : n + 1 + len(pieces)] = self.used + np.cumsum(sizes)
        self.used += len(flat)
        in_order = np.argsort(~plain, kind="stable").tolist()
        self.place.update(zip(map(pieces.__getitem__, in_order), range(n, n + len(pieces))))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts whose UTF-8 bytes stand one after the other, and where each text's ids begin.

        ``bounds``: n + 1 byte offsets from 0 to len(data).
        """
        if len(bounds) == 2 and len(data) > 2 * SLICE_BYTES:
            parts = [self._encode(part, np.array([0, len(part)]))[0] for part in chunks(data, NOT_SPACE)]
            return np.concatenate(parts), np.array([0, sum(map(len, parts))])
        return self._encode(data, bounds)

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, whole = cut_pieces(data, bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        first, inverse = distinct_pieces(data, starts, ends)
        text = data.tobytes()
        pieces = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        at = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if len(new):
            if self.used > CACHE_IDS:
                self._clear()
                new = np.arange(len(pieces))
            unknown = [pieces[i] for i in new.tolist()]
            self._learn(unknown, ~whole[first[new]])
            at[new] = list(map(self.place.__getitem__, unknown))
        places = at[inverse]
        begin = self.begin[places]
        sizes = self.begin[places + 1] - begin
        reached = np.cumsum(sizes)
        ids = self.ids[np.arange(reached[-1]) + np.repeat(begin - reached + sizes, sizes)]
        return ids, np.concatenate([np.zeros(1, np.int64), reached])[np.searchsorted(starts, bounds)]


_WORDS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The one of this Python worker, which keeps what it learned from one task to the next."""
    if path not in _WORDS:
        _WORDS[path] = WordTokens(path)
    return _WORDS[path]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, row): the pieces of every document, its token ids and id 1 at the end.

    Only documents of more than ``capacity`` ids are cut, into full pieces and a last one. ``row`` numbers
    the rows of the input; ``with_ids`` adds the ids themselves. A null text is empty: one piece, id 1 alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        for batch in batches:
            which, piece, start, length, crc, held = [], [], [], [], [], []
            data, bounds = text_bytes(batch.column(2))
            for a, b in slices(bounds):
                found, places = words.encode(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                for j, begin, end in zip(range(a, b), places[:-1].tolist(), places[1:].tolist()):
                    ids = np.append(found[begin:end], np.uint32(END_ID)).astype("<u4", copy=False)
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        which.append(j), piece.append(k), start.append(at), length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            held.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(which, pa.int64())), batch.column(1).take(pa.array(which, pa.int64())),
                       pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(held, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs: the best of several dual feasible functions.

    A function f with sum f(x) <= 1 for every set of lengths that fits a bin proves ceil(sum f(x)) bins.
    Used are x / C (total length), the step functions u_k of Fekete and Schepers for k = 1 to 20, and
    for thresholds t <= C / 2: lengths above C - t count 1, those in [t, C - t] x / C, smaller ones 0.
    """
    if not len(lengths):
        return 0
    x = lengths.astype(np.int64)
    best = -(-int(x.sum()) // capacity)
    for k in range(1, 21):
        whole = (x * (k + 1)) % capacity == 0
        value = np.where(whole, x * (k + 1) * k, ((x * (k + 1)) // capacity) * (k + 1) * capacity)
        # u_k(x) = x / C where (k + 1) x / C is whole, else floor((k + 1) x / C) / k; both over k (k + 1) C.
        best = max(best, -(-int(value.sum()) // (k * (k + 1) * capacity)))
    counts = np.bincount(x, minlength=capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    t = np.arange(0, capacity // 2 + 1)
    big = number[capacity] - number[capacity - t]
    middle = total[capacity - t] - np.where(t > 0, total[t - 1], 0)
    return max(best, int((big + -(-middle // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each length, longest first into the fullest bin that holds it, and the number of bins.

    Bins are kept by free space; the set bits of a number tell which spaces occur.
    """
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, bins = 0, 0
    for j, size in zip(order.tolist(), lengths[order].tolist()):
        fits = spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                spaces &= ~(1 << space)
        else:
            space, at, bins = capacity, bins, bins + 1
        where[j], offset[j] = at, capacity - space
        if space > size:
            if not by_space[space - size]:
                spaces |= 1 << (space - size)
            by_space[space - size].append(at)
    return where, offset, bins


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        lengths = rows["length"].to_numpy()
        where, offset, bins = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(where, lengths, bins)
        return pd.DataFrame({
            "row": rows["row"], "piece": rows["piece"], "length": lengths, "part": rows["part"], "bin": where, "offset": offset,
            "filled": filled[where].astype(np.int64), "bins": bins, "bound": lower_bound(lengths, capacity)})
    return run


_PACKED = "row long, piece int, length long, part long, bin long, offset long, filled long, bins long, bound long"


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (row, piece, length <= capacity, ...) with ``sequence_id`` and ``offset``, in few sequences.

    1. Pieces are dealt by hash to partitions of about ``group_pieces``; each runs best-fit decreasing and
       computes its lower bound.
    2. A partition that used exactly as many sequences as its bound is proved optimal and done.
    3. Of the others every sequence that is not full is opened. Their documents are exchanged between the
       partitions with gaps: dealt anew, into half as many partitions each round, and packed again.
       Half-empty sequences of several partitions meet there. The last round is kept as it is.
    Sequences are filled without gaps from offset 0. ``bins`` and ``bound`` of the result are the sequences of
    the piece's last partition and their proved minimum.

    ``pieces`` has to be a stored table: row numbers must not change between reads. A task holds one
    partition, whatever the lengths; equal lengths are ordered by row and piece. An empty table gives an
    empty table. Columns of ``pieces`` with the added names are replaced.
    """
    added = ("sequence_id", "offset", "bins", "bound")
    pieces = pieces.select(*[F.col(f"`{c}`") for c in pieces.columns if c not in added])
    left, done = pieces.select("row", "piece", "length"), None
    groups = max(1, math.ceil(left.count() / group_pieces))
    for turn in range(rounds + 1):
        part = F.lit(turn << 38) + F.pmod(F.xxhash64(F.lit(turn), "row", "piece"), F.lit(groups))
        dealt = left.withColumn("part", part).repartition(groups, "part")
        packed = stored(dealt.groupBy("part").applyInPandas(_pack(capacity), _PACKED), "packed")
        last = turn == rounds or groups == 1
        closed = packed if last else packed.filter(f"bins = bound or filled = {capacity}")
        done = closed if done is None else done.unionByName(closed)
        left = packed.filter(f"bins > bound and filled < {capacity}").select("row", "piece", "length")
        count = 0 if last else left.count()
        if not count:
            break
        groups = max(1, min(groups // 2, math.ceil(count / group_pieces)))
    # A partition has fewer than 2^22 sequences, a round fewer than 2^38 partitions.
    number = F.shiftright("part", 38) * F.lit(1 << 60) + F.pmod("part", F.lit(1 << 38)) * F.lit(1 << 22) + F.col("bin")
    return pieces.join(done.select("row", "piece", number.alias("sequence_id"), "offset", "bins", "bound"), ["row", "piece"])


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   with_ids: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences: see ``token_pieces`` and ``pack``.

    Rows are documents of their own, repeated ids and equal texts included; other columns are left out.
    """
    pieces = stored(token_pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), "pieces")
    return pack(pieces, capacity, group_pieces).withColumnRenamed("id", id_col)
