"""Counting quotient filters for n-grams of word ids, without loss.

The ids of an n-gram are packed into two halves and permuted invertibly, so that keys spread evenly however
frequent their words are. The top bits of the permuted key are its bucket and quotient, which only the order
of a filter tells; all other bits are the remainder and are stored in full. So a filter is compact, equal keys
are equal n-grams, and two filters merge as sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from formline.llm.texts import mix

# The rounds of the permutation, each with its own constant.
ROUNDS = tuple(np.uint64(0x9E3779B97F4A7C15 * n & 0xFFFFFFFFFFFFFFFF) for n in (1, 3, 5, 7))


@dataclass(frozen=True)
class Layout:
    """How an n-gram of ``words`` ids of ``bits`` bits each is laid out: the first half of the words left, the others right."""

    words: int
    bits: int

    def __post_init__(self):
        if not 1 <= self.bits <= 32:
            raise OverflowError(f"Word ids of {self.bits} bits do not fit; at most 32 do.")

    @property
    def left_words(self) -> int:
        return (self.words + 1) // 2

    @property
    def left_bits(self) -> int:
        return self.left_words * self.bits

    @property
    def right_bits(self) -> int:
        return (self.words - self.left_words) * self.bits

    def _mask(self, bits: int) -> np.uint64:
        return np.uint64((1 << bits) - 1)

    def permuted(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = self._packed(ids[: self.left_words]), self._packed(ids[self.left_words :])
        if not self.right_bits:
            return left, np.zeros_like(left)
        with np.errstate(over="ignore"):
            for a, b in zip(ROUNDS[::2], ROUNDS[1::2]):
                left = left ^ (mix(right + a) & self._mask(self.left_bits))
                right = right ^ (mix(left + b) & self._mask(self.right_bits))
        return left, right

    def restored(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        """The ids that ``permuted`` packed."""
        if self.right_bits:
            with np.errstate(over="ignore"):
                for a, b in zip(ROUNDS[::-2], ROUNDS[-2::-2]):
                    right = right ^ (mix(left + a) & self._mask(self.right_bits))
                    left = left ^ (mix(right + b) & self._mask(self.left_bits))
        return [*self._ids(left, self.left_words), *self._ids(right, self.words - self.left_words)]

    def _packed(self, ids: list[np.ndarray]) -> np.ndarray:
        packed = np.zeros(len(ids[0]) if ids else 0, np.uint64)
        for column in ids:
            packed = (packed << np.uint64(self.bits)) | column.astype(np.uint64)
        return packed

    def _ids(self, packed: np.ndarray, words: int) -> list[np.ndarray]:
        return [(packed >> np.uint64(self.bits * (words - 1 - i))) & self._mask(self.bits) for i in range(words)]

    def counted(self, left: np.ndarray, right: np.ndarray, times: np.ndarray | None = None):
        """The distinct keys in order with their counts, and the place of each given key among them."""
        if self.left_bits + self.right_bits <= 64:
            whole = (left << np.uint64(self.right_bits)) | right if self.right_bits else left
            order = np.argsort(whole, kind="stable")  # runs that are in order already are merged
            ranked = whole[order]
            first = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        else:
            order = np.lexsort((right, left))
            first = np.ones(len(order), bool)
            first[1:] = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
        starts = np.flatnonzero(first)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(first) - 1
        if times is None:
            counts = np.diff(starts, append=len(order))
        else:
            counts = np.add.reduceat(times[order], starts) if len(starts) else np.zeros(0, np.int64)
        return left[order[starts]], right[order[starts]], counts.astype(np.int64), place

    def bucket(self, left: np.ndarray, bucket_bits: int) -> np.ndarray:
        return (left >> np.uint64(self.left_bits - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(left), np.int64)

    def written(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray, bucket_bits: int) -> dict:
        """A bucket's sorted keys as a filter: how many there are of each quotient, the remainders, the counts."""
        quotient_bits = min(self.left_bits - bucket_bits, max(0, len(left).bit_length() - 1), 20)
        low = self.left_bits - bucket_bits - quotient_bits
        quotient = (left >> np.uint64(low)) & self._mask(quotient_bits) if low < 64 else np.zeros(len(left), np.uint64)
        return {
            "size": len(left), "runs": np.bincount(quotient.astype(np.int64), minlength=1 << quotient_bits).astype("<u4").tobytes(),
            "lefts": _narrow(left & self._mask(low), low), "rights": _narrow(right, self.right_bits),
            "counts": _narrow(counts.astype(np.uint64), int(counts.max()).bit_length() if len(counts) else 0)}

    def read(self, row: dict, bucket: int, bucket_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The keys and counts of a filter."""
        runs = np.frombuffer(row["runs"], "<u4")
        quotient_bits = len(runs).bit_length() - 1
        low = self.left_bits - bucket_bits - quotient_bits
        quotient = np.repeat(np.arange(len(runs), dtype=np.uint64), runs)
        high = (np.uint64(bucket) << np.uint64(quotient_bits)) | quotient
        left = ((high << np.uint64(low)) if low < 64 else np.zeros_like(high)) | _wide(row["lefts"], row["size"])
        return left, _wide(row["rights"], row["size"]), _wide(row["counts"], row["size"]).astype(np.int64)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    """Unsigned numbers in as many bytes each as ``bits`` bits need."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    wide = np.zeros((size, 8), np.uint8)
    if size and data:
        narrow = np.frombuffer(data, np.uint8).reshape(size, -1)
        wide[:, : narrow.shape[1]] = narrow
    return wide.view("<u8").reshape(-1)
