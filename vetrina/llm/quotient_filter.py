"""Counting quotient filters of whole keys, as sorted numpy arrays.

A key of one to three 64-bit limbs is permuted by an invertible mixing, so keys are spread evenly. The
high bits of the first limb are the quotient, which the filter's layout implies by run lengths; all
other bits are kept as the remainder, so counts are exact and keys can be got back. Two filters are
merged as sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np

Limbs = list[np.ndarray]
U = np.uint64
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_WORD = 1 << 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(_M1)
    x = (x ^ (x >> U(27))) * U(_M2)
    return x ^ (x >> U(31))


def _unshift(x: np.ndarray, n: int) -> np.ndarray:
    """The inverse of x ^ (x >> n)."""
    out, by = x, n
    while by < 64:
        out = out ^ (out >> U(by))
        by *= 2
    return out


def _unmix(x: np.ndarray) -> np.ndarray:
    x = _unshift(x, 31) * U(pow(_M2, -1, _WORD))
    x = _unshift(x, 27) * U(pow(_M1, -1, _WORD))
    return _unshift(x, 30)


def permute(limbs: Limbs) -> Limbs:
    """A bijection; each bit of a key stirs the first limb."""
    out = [*limbs[:-1], _mix(limbs[-1])]
    for i in range(len(out) - 2, -1, -1):
        out[i] = _mix(out[i] ^ out[i + 1])
    return out


def restore(limbs: Limbs) -> Limbs:
    """The inverse of permute()."""
    return [_unmix(a) ^ b for a, b in zip(limbs, limbs[1:])] + [_unmix(limbs[-1])]


class QuotientFilter:
    """Distinct permuted keys in order, with their counts."""

    def __init__(self, limbs: Limbs, counts: np.ndarray) -> None:
        self.limbs, self.counts = limbs, counts

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def of(cls, limbs: Limbs, counts: np.ndarray | None = None) -> QuotientFilter:
        """Counts permuted keys; a key may come often, each time with a count of its own (by default 1)."""
        if not len(limbs[0]):
            return cls(limbs, np.zeros(0, dtype=np.int64))
        order = np.argsort(limbs[0])
        x = [a[order] for a in limbs]
        same = x[0][1:] == x[0][:-1]
        if any((same & (a[1:] != a[:-1])).any() for a in x[1:]):  # keys that share a first limb may alternate
            order = np.lexsort(limbs[::-1])
            x = [a[order] for a in limbs]
        first = np.ones(len(order), dtype=bool)
        first[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in x])
        starts = np.flatnonzero(first)
        n = np.diff(np.append(starts, len(order))) if counts is None else np.add.reduceat(counts[order], starts)
        return cls([a[starts] for a in x], n.astype(np.int64))

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        if len(filters) == 1:
            return filters[0]
        return cls.of([np.concatenate(a) for a in zip(*(f.limbs for f in filters))], np.concatenate([f.counts for f in filters]))

    def at_least(self, n: int) -> QuotientFilter:
        return QuotientFilter([a[self.counts >= n] for a in self.limbs], self.counts[self.counts >= n])

    def parts(self, bits: int) -> list[tuple[int, QuotientFilter]]:
        """Filters by the first bits of the quotient, without empty ones."""
        if not len(self):
            return []
        part = (self.limbs[0] >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(self), dtype=np.int64)
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(part))
        return [(int(part[a]), QuotientFilter([x[a:b] for x in self.limbs], self.counts[a:b])) for a, b in zip(starts, ends)]

    def dump(self, bits: int = 0) -> bytes:
        """As bytes; all keys share their first bits, which are left out.

        Layout: sizes, the run length of each quotient, remainders in as few bytes as hold them, the other limbs, counts in a
        byte each with 255 for those that follow in full.
        """
        n = len(self)
        q = min(max(n, 1).bit_length() - 1, 64 - bits)
        rest = 64 - bits - q
        low = self.limbs[0] & U((1 << (64 - bits)) - 1) if bits else self.limbs[0]
        runs = np.bincount((low >> U(rest)).astype(np.int64) if rest < 64 else np.zeros(n, dtype=np.int64), minlength=1 << q)
        wide = "<u4" if runs.max(initial=0) > 255 else "<u1"
        width = (rest + 7) // 8
        remainder = (low & U((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        large = self.counts[self.counts >= 255]
        return b"".join([struct.pack("<qiiii", n, len(self.limbs), q, int(wide[2:]), len(large)), runs.astype(wide).tobytes(), remainder.tobytes(),
                         *(a.astype("<u8").tobytes() for a in self.limbs[1:]), np.minimum(self.counts, 255).astype(np.uint8).tobytes(), large.astype("<i8").tobytes()])

    @classmethod
    def load(cls, data: bytes, part: int = 0, bits: int = 0) -> QuotientFilter:
        n, n_limbs, q, wide, n_large = struct.unpack_from("<qiiii", data)
        at = struct.calcsize("<qiiii")

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        rest = 64 - bits - q
        width = (rest + 7) // 8
        runs = take(f"<u{wide}", 1 << q)
        full = np.zeros((n, 8), dtype=np.uint8)
        full[:, :width] = take("<u1", n * width).reshape(n, width)
        first = full.reshape(-1).view("<u8").astype(np.uint64)
        if rest < 64:
            first |= np.repeat(np.arange(1 << q, dtype=np.uint64), runs) << U(rest)
        if bits:
            first |= U(part << (64 - bits))
        limbs = [first, *(take("<u8", n).astype(np.uint64) for _ in range(n_limbs - 1))]
        counts = take("<u1", n).astype(np.int64)
        counts[counts == 255] = take("<i8", n_large)
        return cls(limbs, counts)
