"""Exact integer matrix products by residues, in float32."""

from __future__ import annotations

import numpy as np

#: Residues are at most 254 to either side of 0, so sums of this many products stay below 2^24, up to
#: which float32 has every whole number.
CHUNK = 256
LARGEST_PRIME = 509


def _primes() -> list[int]:
    """Primes from ``LARGEST_PRIME`` down, as many as a signed 64-bit number has room for."""
    found, product = [], 1
    for p in range(LARGEST_PRIME, 2, -1):
        if all(p % d for d in range(2, int(p**0.5) + 1)):
            if product * p >= 2**63:
                break
            found.append(p)
            product *= p
    return found


PRIMES = _primes()


def _centred(values: np.ndarray, prime: int) -> np.ndarray:
    """The residues nearest 0, as float32."""
    rest = values % prime
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


class ResidueMatrix:
    """Rows of whole numbers whose products with other rows are wanted.

    ``score(rows)`` gives the products as int64. Each is exact as long as it, doubled, is below the
    product of all ``PRIMES``, some 6.8e18; a greater bound raises OverflowError.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.most = int(np.abs(rows).max(initial=0))
        self._residues: dict[int, np.ndarray] = {}

    def _residue(self, prime: int) -> np.ndarray:
        if prime not in self._residues:
            self._residues[prime] = np.ascontiguousarray(_centred(self.rows, prime).T)
        return self._residues[prime]

    def scores(self, left: np.ndarray) -> np.ndarray:
        """``left`` times the transposed rows, exactly."""
        bound = 2 * left.shape[1] * int(np.abs(left).max(initial=0)) * self.most
        found, modulus = np.zeros((len(left), len(self.rows)), np.int64), 1
        for prime in PRIMES:
            if modulus > bound:
                break
            rest = self._product(_centred(left, prime), prime)
            # The next digit of the mixed-radix form: found + modulus * digit has this residue too.
            digit = (rest - found) % prime * pow(modulus, -1, prime) % prime if modulus > 1 else rest
            found += modulus * digit
            modulus *= prime
        if modulus <= bound:
            raise OverflowError(f"products up to {bound // 2} are beyond the residue system")
        return np.where(found > modulus // 2, found - modulus, found)

    def _product(self, left: np.ndarray, prime: int) -> np.ndarray:
        """The product's residues, 0 to ``prime - 1``."""
        right = self._residue(prime)
        total = np.zeros((len(left), right.shape[1]), np.int64)
        for start in range(0, left.shape[1], CHUNK):
            part = left[:, start : start + CHUNK] @ right[start : start + CHUNK]
            total += part.astype(np.int64)
        return total % prime
