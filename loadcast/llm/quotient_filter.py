"""Counting quotient filters: sorted, compact and lossless counters of packed keys.

A key of ``2 * half`` bits is scrambled by an invertible permutation (four Feistel rounds), so that
keys spread evenly and can be read back.  The top bits of a scrambled key name its shard; in the shard
the next bits are the quotient, which is not stored but given by the place of its run, and the
full remainder is.  A filter is a stream of slots in key order with three bit vectors:

* ``occupied`` (one bit per quotient): the quotient has a run;
* ``run end`` (one bit per slot): the last slot of a run;
* ``extra`` (one bit per slot): the slot is a digit of the counter of the entry before it.

An entry seen once takes one slot.  Further digits hold ``count - 1``, lowest digit first, in as many
slots as it needs.  As remainders are kept whole, counts are exact, and filters of one
shard merge by their order.
"""

from __future__ import annotations

import struct

import numpy as np

from loadcast.llm.words import mix

_HEAD = struct.Struct("<QQBBB")
_ROUNDS = tuple(np.uint64(k * 0x9E3779B97F4A7C15 % 2**64) for k in (1, 2, 3, 4))
MAX_QUOTIENT = 26


class Layout:
    """How ``width`` word ids of ``bits`` bits are packed, scrambled and dealt over 2^s shards."""

    def __init__(self, width: int, bits: int, shard_bits: int) -> None:
        self.width, self.bits = width, bits
        self.half = (width * bits + 1) // 2
        self.shard_bits = min(max(shard_bits, 2 * self.half - 64), self.half)
        self.key_bits = 2 * self.half - self.shard_bits
        if self.key_bits > 64:
            raise ValueError(f"{width} ids of {bits} bits don't fit")
        self._mask = np.uint64((1 << self.half) - 1)

    def _cut(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The concatenated bits of the ids as two halves."""
        left = np.zeros(len(columns[0]), np.uint64)
        right = left.copy()
        for place, ids in enumerate(reversed(columns)):
            low = place * self.bits
            if low >= self.half:
                left |= ids << np.uint64(low - self.half)
            else:
                right |= (ids << np.uint64(low)) & self._mask
                if low + self.bits > self.half:
                    left |= ids >> np.uint64(self.half - low)
        return left, right

    def scramble(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Shard and key of each packed tuple of ids (``columns``: one uint64 array per place)."""
        left, right = self._cut(columns)
        for salt in _ROUNDS:
            left, right = right, left ^ (mix(right + salt) & self._mask)
        low = np.uint64(self.half - self.shard_bits)
        inner = left & np.uint64((1 << int(low)) - 1)
        return left >> low, (inner << np.uint64(self.half)) | right

    def restore(self, shard: int, keys: np.ndarray) -> list[np.ndarray]:
        """The ids of scrambled keys of one shard."""
        low = self.half - self.shard_bits
        right = keys & self._mask
        left = (keys >> np.uint64(self.half)) if low else np.zeros_like(keys)
        left = left | np.uint64(shard << low)
        for salt in reversed(_ROUNDS):
            left, right = right ^ (mix(left + salt) & self._mask), left
        columns, mask = [], np.uint64((1 << self.bits) - 1)
        for place in reversed(range(self.width)):
            low = place * self.bits
            if low >= self.half:
                ids = left >> np.uint64(low - self.half)
            else:
                ids = right >> np.uint64(low)
                if low + self.bits > self.half:
                    ids = ids | (left << np.uint64(self.half - low))
            columns.append(ids & mask)
        return columns


def combine(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed counts; sorted runs in ``keys`` are merged, not re-sorted."""
    if len(keys) == 0:
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def pack(keys: np.ndarray, counts: np.ndarray, key_bits: int) -> bytes:
    """A filter of sorted distinct keys and their counts (1 or more)."""
    n = len(keys)
    quotient_bits = min(max(n.bit_length() - 1, 0), key_bits, MAX_QUOTIENT)
    rest_bits = key_bits - quotient_bits
    size = max(1, (rest_bits + 7) // 8)
    rest = keys if rest_bits == 64 else keys & np.uint64((1 << rest_bits) - 1)
    quotient = (
        np.zeros(n, np.int64) if rest_bits == 64 else (keys >> np.uint64(rest_bits)).astype(np.int64)
    )
    left, digits = (counts - 1).astype(np.uint64), np.zeros(n, np.int64)
    step = np.uint64(min(8 * size, 63))
    while left.any():
        digits += left > 0
        left = left >> step
    ends = np.cumsum(digits + 1)
    slots, starts = int(ends[-1]) if n else 0, ends - digits - 1
    values = np.zeros(slots, np.uint64)
    extra = np.ones(slots, bool)
    values[starts], extra[starts] = rest, False
    left, at, one = (counts - 1).astype(np.uint64), starts + 1, np.uint64((1 << int(step)) - 1)
    chosen = np.flatnonzero(left)
    while len(chosen):
        values[at[chosen]] = left[chosen] & one
        left[chosen] = left[chosen] >> step
        at[chosen] += 1
        chosen = chosen[left[chosen] > 0]
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    run_end = np.zeros(slots, bool)
    if n:
        run_end[ends[np.r_[quotient[1:] != quotient[:-1], True]] - 1] = True
    body = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    parts = [np.packbits(x).tobytes() for x in (occupied, run_end, extra)]
    head = _HEAD.pack(n, slots, key_bits, quotient_bits, size)
    return b"".join([head, *parts, body.tobytes()])


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and counts of a filter."""
    n, slots, key_bits, quotient_bits, size = _HEAD.unpack_from(data)
    at = _HEAD.size
    vectors = []
    for length in (1 << quotient_bits, slots, slots):
        packed = np.frombuffer(data, np.uint8, (length + 7) // 8, at)
        vectors.append(np.unpackbits(packed, count=length).view(bool))
        at += len(packed)
    occupied, run_end, extra = vectors
    body = np.zeros((slots, 8), np.uint8)
    body[:, :size] = np.frombuffer(data, np.uint8, slots * size, at).reshape(slots, size)
    values = body.reshape(-1).view("<u8").astype(np.uint64)
    starts = np.flatnonzero(~extra)
    run = np.cumsum(run_end) - run_end
    quotient = np.flatnonzero(occupied)[run[starts]].astype(np.uint64)
    rest_bits = key_bits - quotient_bits
    keys = values[starts] if rest_bits == 64 else (quotient << np.uint64(rest_bits)) | values[starts]
    counts = np.ones(n, np.int64)
    digits = np.diff(np.r_[starts, slots]) - 1
    step = min(8 * size, 63)
    for place in range(int(digits.max(initial=0))):
        chosen = np.flatnonzero(digits > place)
        digit = values[starts[chosen] + 1 + place] << np.uint64(step * place)
        counts[chosen] += digit.astype(np.int64)
    return keys, counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed counts of several filters of one shard."""
    parts = [unpack(f) for f in filters]
    return combine(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
