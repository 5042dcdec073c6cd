"""Gap-weighted subsequence kernel on short character strings, vectorised over many strings.

A string's features are its ordered letter triples, gaps allowed; a triple
that spans ``d`` characters weighs ``DECAY ** d``. The kernel of two strings
is the cosine of their feature vectors. Symbols, digits and spaces take up a
position (they widen gaps) but are in no triple, so ``i-d-i-o-t`` stays close
to ``idiot``, and an inserted letter only adds a few features. A start mark
counts as a letter, so that a stem at the start of a word differs from the
same letters inside one.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from itertools import combinations

import numpy as np

WIDTH = 17
STRIDE = 8
DECAY = 0.8
START = "\x02"
# Codes: a-z, hashed letters of other scripts, the start mark, a gap.
OTHER, HASHED = 26, 16
FIRST, GAP, CODES = OTHER + HASHED, OTHER + HASHED + 1, OTHER + HASHED + 2


def _code(point: int) -> int:
    """Code of a character: its unaccented letter a-z, one of ``HASHED`` codes of other letters, the start mark, or a gap."""
    base = unicodedata.normalize("NFKD", chr(point))[0].lower()
    if "a" <= base <= "z":
        return ord(base) - ord("a")
    if chr(point) == START:
        return FIRST
    return OTHER + ord(base) * 2654435761 % 2**32 * HASHED // 2**32 if base.isalpha() else GAP


@cache
def _table() -> np.ndarray:
    """Codes of all code points; a lone surrogate is a gap."""
    return np.fromiter((_code(p) for p in range(0x110000)), np.uint8, 0x110000)


@cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    i, j, k = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3).T
    return i, j, k, DECAY ** (k - i + 1.0)


def encode(units: list[str], n: int) -> np.ndarray:
    """Codes of units of length ``n``: see :func:`_code`."""
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)
    return _table()[points].astype(np.int64)


def by_length(units: list[str]) -> dict[int, np.ndarray]:
    """Positions of the units of each length."""
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def squared_norms(codes: np.ndarray) -> np.ndarray:
    """k(u, u) before normalising: equal triples of a unit add up before squaring."""
    rows, n = codes.shape
    if n < 3:
        return np.zeros(rows)
    # before[a, b]: weight of common subsequences of the prefixes that end before a and b,
    # each with the gaps up to a and b counted.
    same = (codes[:, :, None] == codes[:, None, :]) & (codes != GAP)[:, :, None]
    before = np.ones((rows, n, n))
    for _ in range(2):
        ends = np.where(same, before, 0.0) * DECAY**2
        after = np.zeros((rows, n, n))
        for a in range(1, n):
            for b in range(1, n):
                after[:, a, b] = (
                    ends[:, a - 1, b - 1]
                    + DECAY * after[:, a - 1, b]
                    + DECAY * after[:, a, b - 1]
                    - DECAY**2 * after[:, a - 1, b - 1]
                )
        before = after
    return np.where(same, before, 0.0).sum(axis=(1, 2)) * DECAY**2


def weighted_sums(units: list[str], table: np.ndarray) -> np.ndarray:
    """Sums over a unit's triples of ``weight * table[triple]``, divided by the unit's norm (0 without triples).

    ``table`` has a row per triple code and any number of columns; the result
    has a row per unit and the same columns.
    """
    flat = table.reshape(CODES**3, -1)
    out = np.zeros((len(units), flat.shape[1]))
    for n, at in by_length(units).items():
        if n < 3:
            continue
        i, j, k, w = _triples(n)
        step = max(64, (1 << 20) // max(n * n, 16 * flat.shape[1]))
        for lo in range(0, at.size, step):
            part = at[lo : lo + step]
            codes = encode([units[x] for x in part], n)
            left, right = codes * (CODES * CODES), codes * CODES
            total = np.zeros((part.size, flat.shape[1]))
            for x in range(i.size):
                total += w[x] * flat[left[:, i[x]] + right[:, j[x]] + codes[:, k[x]]]
            norm = np.sqrt(squared_norms(codes))[:, None]
            out[part] = np.divide(total, norm, out=np.zeros_like(total), where=norm > 1e-6)
    return out


def features(unit: str) -> np.ndarray:
    """The normalised feature vector of one unit as a dense table over triples of codes."""
    table = np.zeros((CODES, CODES, CODES))
    n = len(unit)
    if n >= 3:
        c = encode([unit], n)[0]
        i, j, k, w = _triples(n)
        real = (c[i] != GAP) & (c[j] != GAP) & (c[k] != GAP)
        np.add.at(table, (c[i][real], c[j][real], c[k][real]), w[real])
    norm = np.sqrt((table**2).sum())
    return table / norm if norm > 1e-6 else table


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """The kernel of every unit with every landmark."""
    table = np.empty((CODES**3, len(landmarks)))
    for i, x in enumerate(landmarks):
        table[:, i] = features(x).reshape(-1)
    return weighted_sums(units, table)
