"""Exact products of integer matrices from float32 products modulo small primes.

Each matrix is reduced modulo several primes. Residues are so small that a float32 product of them is exact;
the Chinese remainder theorem gives back the signed integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

EXACT = 1 << 24  # float32 holds every integer up to here
SMALL = 512


def is_prime(n: int) -> bool:
    return n > 1 and all(n % q for q in range(2, int(n ** 0.5) + 1))


def primes() -> Iterator[int]:
    """Primes from ``SMALL`` downward, then those above it: larger ones allow shorter sums only."""
    yield from filter(is_prime, range(SMALL, 2, -1))
    yield from filter(is_prime, range(SMALL, 8192))


def primes_for(bits: float) -> list[int]:
    """Primes whose product tells apart all signed integers below 2 ** ``bits``."""
    chosen, have = [], 0.0
    for p in primes():
        if have > bits + 1.01:
            return chosen
        chosen.append(p)
        have += float(np.log2(p))
    raise ValueError(f"too few primes for {bits} bits")


def log_norms(levels: np.ndarray) -> np.ndarray:
    """Binary logarithm of the length of each row, without overflow; 0 at least."""
    top = np.abs(levels).max(axis=1, initial=1.0)
    return np.log2(top) + np.log2(np.maximum(1.0, np.square(levels / top[:, None]).sum(axis=1))) / 2


def residues(levels: np.ndarray, p: int) -> np.ndarray:
    """Integers, held as doubles of any size, modulo p, as float32 from -p/2 to p/2."""
    r = np.fmod(levels, p)
    return (r - p * np.rint(r / p)).astype(np.float32)


def product_modulo(left: np.ndarray, right: np.ndarray, p: int) -> np.ndarray:
    """left @ right.T modulo p, of residues, in stretches of dimensions whose sums are exact."""
    step, total = EXACT // (p // 2 + 1) ** 2, None
    for at in range(0, max(1, left.shape[1]), step):
        part = left[:, at:at + step] @ right[:, at:at + step].T
        part -= np.float32(p) * np.rint(part / np.float32(p))
        if total is None:
            total = part
        else:
            total += part
            total -= np.float32(p) * np.rint(total / np.float32(p))
    return total


class Residues:
    """A matrix modulo each prime."""

    def __init__(self, levels: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.parts = [residues(levels, p) for p in moduli]

    def rows(self, at: slice) -> list[np.ndarray]:
        return [part[at] for part in self.parts]


def product(left: Residues, right: Residues, rows: slice, columns: slice) -> np.ndarray:
    """Part of left @ right.T as signed integers: longs, or Python's where the moduli's product needs them."""
    whole = 1
    for p in left.moduli:
        whole *= p
    kind = np.int64 if whole < 1 << 61 else object
    value, modulus = None, 1
    for p, a, b in zip(left.moduli, left.rows(rows), right.rows(columns), strict=True):
        r = product_modulo(a, b, p).astype(np.int64).astype(kind)
        if value is None:
            value = r % p
        else:  # the next mixed-radix digit
            value = value + (r - value) % p * pow(modulus, -1, p) % p * modulus
        modulus *= p
    return value - modulus * (value > modulus // 2).astype(kind)
