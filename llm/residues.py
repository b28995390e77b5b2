"""Exact signed integer matrix products from float32 products modulo several small primes."""

from __future__ import annotations

import math

import numpy as np

#: float32 holds every integer up to here.
EXACT = 1 << 24
#: Columns multiplied at once; with more, the products are reduced and added slice by slice.
SLICE = 256


def primes_for(columns: int, largest: int) -> list[int]:
    """Odd primes whose product passes twice any inner product of ``columns`` components up to ``largest``.

    A residue is at most (p - 1) / 2 in size, so a slice's sum of products stays where float32 is exact.
    """
    bound = columns * largest * largest
    if bound >= 1 << 63:
        raise ArithmeticError(f"an inner product of {columns} components up to {largest} may not fit in 64 bits")
    found, product = [], 1
    p = 2 * math.isqrt(EXACT // max(1, min(columns, SLICE))) + 1
    while product <= 2 * bound + 1:
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def _reduced(x: np.ndarray, p: int) -> np.ndarray:
    """The residue nearest to zero; ``x`` float64 and integer."""
    return x - p * np.rint(x / p)


class Residues:
    """An integer matrix as its residues modulo ``primes``, each a float32 matrix."""

    def __init__(self, matrix: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [((matrix + p // 2) % p - p // 2).astype(np.float32) for p in primes]

    def rows(self, start: int, end: int) -> "Residues":
        out = object.__new__(Residues)
        out.primes, out.parts = self.primes, [m[start:end] for m in self.parts]
        return out

    def times(self, other: "Residues") -> np.ndarray:
        """self @ other.T as int64.

        The residues of the products give, prime by prime, the digits of each score in a mixed radix with digits around
        zero (Chinese remaindering after Garner), whose value is the signed score itself.
        """
        digits = []
        for k, p in enumerate(self.primes):
            a, b = self.parts[k], other.parts[k]
            rest = np.zeros((len(a), len(b)))
            for at in range(0, a.shape[1], SLICE):
                product = (a[:, at : at + SLICE] @ b[:, at : at + SLICE].T).astype(np.float64)
                rest = _reduced(rest + _reduced(product, p), p)
            for q, digit in zip(self.primes, digits):
                rest = _reduced((rest - digit) * pow(q, -1, p), p)
            digits.append(rest)
        out = np.zeros((len(self.parts[0]), len(other.parts[0])), np.int64) if self.primes else None
        for p, digit in zip(reversed(self.primes), reversed(digits)):
            out = out * p + digit.astype(np.int64)
        return out
