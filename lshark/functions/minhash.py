"""MinHash model: coefficient generation and native signature expressions.

Semantics follow Spark ML's ``MinHashLSH``: a set is the set of its non-zero
indices, table ``t`` hashes an element ``x`` to ``((1 + x) * a_t + b_t) mod P``
and the signature entry is the minimum over the set.  Coefficients are drawn
with ``java.util.Random(seed)`` exactly as the ML class does, so a model fitted
here and one fitted by ``pyspark.ml.feature.MinHashLSH`` hash identically.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime used by Spark ML's MinHashLSH.
HASH_PRIME = 2038074743

_MASK48 = (1 << 48) - 1
_MULT = 0x5DEECE66D


class JavaRandom:
    """The 48-bit linear congruential generator of ``java.util.Random``."""

    def __init__(self, seed: int):
        self._seed = (seed ^ _MULT) & _MASK48

    def _next(self, bits: int) -> int:
        self._seed = (self._seed * _MULT + 0xB) & _MASK48
        r = self._seed >> (48 - bits)
        return r - (1 << 32) if r >= (1 << 31) else r

    def next_int(self, bound: int) -> int:
        if bound <= 0:
            raise ValueError("bound must be positive")
        r = self._next(31)
        m = bound - 1
        if bound & m == 0:
            return (bound * r) >> 31
        u = r
        r = u % bound
        # Java rejects draws whose 32-bit sum ``u - r + m`` overflows.
        while u - r + m >= (1 << 31):
            u = self._next(31)
            r = u % bound
        return r


def coefficients(num_tables: int, seed: int) -> list[tuple[int, int]]:
    rnd = JavaRandom(seed)
    out = []
    for _ in range(num_tables):
        a = 1 + rnd.next_int(HASH_PRIME - 1)
        b = rnd.next_int(HASH_PRIME - 1)
        out.append((a, b))
    return out


@dataclass(frozen=True)
class MinHashModel:
    """A fitted MinHash LSH model: ``num_tables`` (a, b) pairs and their seed
    (None where a loaded model does not tell)."""

    num_tables: int
    seed: int | None
    coeffs: tuple[tuple[int, int], ...] = field(default=())

    def hash_col(self, item: Column, t: int) -> Column:
        """Table ``t`` hash of one element (bigint, in [0, P)).

        The element is reduced modulo P first, so any bigint is accepted and
        the product stays below 2**62; for ids below P this is Spark ML's
        value.  Ids that differ by a multiple of P hash alike in every table:
        they can add candidates but no result, as pairs are verified on ids.
        """
        a, b = self.coeffs[t]
        p = F.lit(HASH_PRIME)
        return F.pmod(F.pmod(F.pmod(item.cast("bigint"), p) + F.lit(1), p) * F.lit(a) + F.lit(b), p)

    def signature(self, items) -> list[int]:
        """Signature of one small set outside a query (a probe of an index)."""
        return [min(((1 + x % HASH_PRIME) % HASH_PRIME * a + b) % HASH_PRIME for x in items) for a, b in self.coeffs]


def fit(num_tables: int = 5, seed: int = 42) -> MinHashModel:
    """Draw the coefficients for ``num_tables`` tables (D1).

    Like the ML estimator this needs no pass over the data: the hash family is
    fixed by the seed alone.
    """
    if num_tables < 1:
        raise ValueError("num_tables must be at least 1")
    return MinHashModel(num_tables, seed, tuple(coefficients(num_tables, seed)))
