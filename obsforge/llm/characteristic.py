"""Exact eigenvalues of a symmetric positive semidefinite integer matrix by its characteristic polynomial.

The polynomial is computed modulo primes below 2**31, by reduction to Hessenberg form, and joined by Chinese remaindering.
As all its roots are real, the sign changes of its coefficients after a shift count the roots above the shift exactly,
copies included, so bisection with integers isolates each root to any width. Vectors come from inverse iteration in
decimal arithmetic, with the root as the shift.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb, prod

import numpy as np

PRIME_BITS = 31
#: Bits of a root after the leading one of the mean eigenvalue.
ROOT_BITS = 160
#: Digits that inverse iteration carries beyond those of the matrix, and its rounds.
DIGITS, ROUNDS = 60, 4


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    # these bases decide every n below 3.2 * 10**9
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(product_above: int) -> list[int]:
    """The largest primes of ``PRIME_BITS`` bits, as many as their product needs to exceed the given number."""
    found, product, n = [], 1, 1 << PRIME_BITS
    while product <= product_above:
        n -= 1
        if _is_prime(n):
            found.append(n)
            product *= n
    return found


def coefficient_bound(trace: int, size: int) -> int:
    """No coefficient is larger: symmetric functions of non-negative roots are largest where all roots are equal."""
    return max((comb(size, k) * (Fraction(trace, size) ** k) for k in range(size + 1)), default=1).__ceil__()


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(xI - matrix) modulo p, that of the highest power last."""
    h = np.array(matrix % p, dtype=np.int64)
    n = len(h)
    for k in range(n - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        # each product is below p after its own reduction, so the sum stays far below 2**63
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    lead = [np.zeros(n + 1, dtype=np.int64)]
    lead[0][0] = 1
    for k in range(n):
        own = np.roll(lead[k], 1)
        own = (own - int(h[k, k]) * lead[k]) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            own = (own - (int(h[i, k]) * chain % p) * lead[i]) % p
        lead.append(own)
    return [int(c) for c in lead[n]]


def join_residues(residues: dict[int, list[int]]) -> list[int]:
    """The integers nearest to zero that have the given residues modulo each prime."""
    moduli = list(residues)
    whole = prod(moduli)
    weights = [whole // p * pow(whole // p, -1, p) for p in moduli]
    joined = []
    for column in zip(*(residues[p] for p in moduli), strict=True):
        value = sum(r * w for r, w in zip(column, weights, strict=True)) % whole
        joined.append(value - whole if 2 * value > whole else value)
    return joined


def _roots_above(coefficients: list[int], at: int) -> int:
    shifted = list(coefficients)
    n = len(shifted)
    for low in range(n - 1):
        carry = shifted[-1]
        for i in range(n - 2, low - 1, -1):
            carry = shifted[i] = shifted[i] + at * carry
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(coefficients: list[int], many: int) -> list[Fraction]:
    """The largest positive roots with their copies, falling; each is at most its value and 2**-ROOT_BITS of the mean off."""
    degree = len(coefficients) - 1
    trace = -coefficients[-2] if degree else 0
    if trace <= 0:
        return []
    scale = max(0, ROOT_BITS - (trace // degree).bit_length())
    scaled = [c << scale * (degree - i) for i, c in enumerate(coefficients)]
    seen: dict[int, int] = {}

    def above(at: int) -> int:
        if at not in seen:
            seen[at] = _roots_above(scaled, at)
        return seen[at]

    found: list[Fraction] = []
    high = trace << scale
    for turn in range(1, min(many, above(0)) + 1):
        low = max((at for at, n in seen.items() if n >= turn), default=0)
        high = min(at for at in (high, *seen) if seen.get(at, 0) < turn)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= turn else (low, middle)
        found.append(Fraction(high, 1 << scale))
    return found


def _factors(matrix: np.ndarray, least: Decimal) -> tuple[np.ndarray, list[int]]:
    """LU factors with row exchanges; a vanishing pivot becomes ``least``."""
    lu, order = matrix.copy(), list(range(len(matrix)))
    for k in range(len(lu)):
        at = k + max(range(len(lu) - k), key=lambda i: abs(lu[k + i, k]))
        if at != k:
            lu[[k, at]] = lu[[at, k]]
            order[k], order[at] = order[at], order[k]
        if abs(lu[k, k]) < least:
            lu[k, k] = least
        lu[k + 1 :, k] /= lu[k, k]
        lu[k + 1 :, k + 1 :] -= np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
    return lu, order


def _solve(lu: np.ndarray, order: list[int], right: np.ndarray) -> np.ndarray:
    x = right[order]
    for k in range(len(x)):
        x[k] -= lu[k, :k] @ x[:k] if k else 0
    for k in range(len(x) - 1, -1, -1):
        x[k] = (x[k] - (lu[k, k + 1 :] @ x[k + 1 :] if k + 1 < len(x) else 0)) / lu[k, k]
    return x


def unit_vectors(matrix: np.ndarray, roots: list[Fraction]) -> np.ndarray:
    """A unit eigenvector for each root, orthogonal to one another; the largest entry is positive."""
    size = len(matrix)
    trace = sum(int(matrix[i, i]) for i in range(size))
    found: list[np.ndarray] = []
    with localcontext() as context:
        context.prec = DIGITS + len(str(trace))
        exact = np.array([[Decimal(int(c)) for c in row] for row in matrix], dtype=object).reshape(size, size)
        least = Decimal(trace).scaleb(-DIGITS)
        for turn, root in enumerate(roots):
            shift = Decimal(root.numerator) / Decimal(root.denominator)
            lu, order = _factors(exact - np.diag([shift] * size), least)
            # no start is special to any matrix; each turn has its own
            x = np.array([Decimal(1 + (i * 7919 + turn * 104729) % 1009) for i in range(size)], dtype=object)
            for _ in range(ROUNDS):
                x = _solve(lu, order, x)
                for _ in range(2):
                    for other in found:
                        x = x - (x @ other) * other
                    x = x / (x @ x).sqrt()
            found.append(x)
    out = np.array([[float(c) for c in x] for x in found]).reshape(len(found), size)
    for row in out:
        if row[np.abs(row).argmax()] < 0:
            row *= -1
    return out
