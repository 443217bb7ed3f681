"""Exact eigenvalues and eigenvectors of an integer symmetric matrix.

The characteristic polynomial is found modulo primes below 2^31, by Hessenberg reduction, and put
together by the Chinese remainder theorem. Its roots are all real, so the sign changes of the
polynomial moved by a point count its roots above that point (Descartes), with their multiplicity:
bisection on integers isolates each root, and vectors come from inverse iteration in decimals.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np

LARGEST = 1 << 31
ROOT_BITS = 160  # bits of a root below the bits of the trace
DIGITS = 120


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide it for n below 2^32."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (0, 1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31 whose product has more than `bits` bits."""
    found, product, n = [], 0.0, LARGEST - 1
    while product <= bits:
        if _is_prime(n):
            found.append(n)
            product += math.log2(n) - 1e-9
        n -= 2
    return found


def coefficient_bits(trace: int, size: int) -> int:
    """No coefficient of a matrix without negative eigenvalues has more bits: the k-th is at most
    binomial(size, k) * (trace / size)^k."""
    mean = max(1.0, math.log2(max(1, trace)) - math.log2(size) + 1e-6)
    return math.ceil(max(math.log2(math.comb(size, k)) + k * mean for k in range(size + 1))) + 3


def _inverse(values: np.ndarray, modulo: np.ndarray) -> np.ndarray:
    """Inverses modulo primes; 0 of 0."""
    out, power, rest = np.ones_like(values), values.copy(), modulo - 2
    while (rest > 0).any():
        out = np.where(rest % 2 == 1, out * power % modulo, out)
        power, rest = power * power % modulo, rest // 2
    return out


def residues(matrix: list[list[int]], moduli: list[int]) -> np.ndarray:
    """Coefficients, lowest power first, of the characteristic polynomial modulo each prime."""
    size, count = len(matrix), len(moduli)
    p = np.array(moduli, np.int64)
    wide = np.array(matrix, object)
    h = np.stack([(wide % m).astype(np.int64) for m in moduli]).reshape(count, size, size)
    every, p1, p2 = np.arange(count), p[:, None], p[:, None, None]
    for k in range(1, size - 1):
        # Bring an entry that is not 0 to row k of column k - 1, where there is one.
        pivot = k + np.argmax(h[:, k:, k - 1] != 0, axis=1)
        for axis in (1, 2):
            view = h if axis == 1 else h.transpose(0, 2, 1)
            held = view[every, k].copy()
            view[every, k] = view[every, pivot]
            view[every, pivot] = held
        factor = h[:, k + 1:, k - 1] * _inverse(h[:, k, k - 1], p)[:, None] % p1
        h[:, k + 1:] = (h[:, k + 1:] - factor[:, :, None] * h[:, k][:, None, :] % p2) % p2
        # The columns' counterpart, summed in halves so that no sum of products leaves 63 bits.
        moved = h[:, :, k + 1:]
        low, high = factor & 0xFFFF, factor >> 16
        part = (moved @ low[:, :, None])[:, :, 0] % p1
        more = (moved @ high[:, :, None])[:, :, 0] % p1 * (1 << 16) % p1
        h[:, :, k] = (h[:, :, k] + part + more) % p1
    # The polynomials of the leading blocks of a Hessenberg matrix, one after the other.
    found = [np.zeros((count, size + 1), np.int64)]
    found[0][:, 0] = 1
    for k in range(size):
        new = np.zeros((count, size + 1), np.int64)
        new[:, 1:] = found[k][:, :-1]
        new = (new - h[:, k, k][:, None] * found[k]) % p1
        below = np.ones(count, np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            new = (new - (below * h[:, i, k] % p)[:, None] * found[i] % p1) % p1
        found.append(new)
    return found[size]


def combined(rows: list[list[int]], moduli: list[int]) -> list[int]:
    """Whole coefficients, of either sign, from their residues modulo each prime."""
    product = math.prod(moduli)
    parts = [product // m * pow(product // m % m, -1, m) for m in moduli]
    whole = [sum(r * part for r, part in zip(column, parts, strict=True)) % product
             for column in zip(*rows, strict=True)]
    return [w - product if 2 * w > product else w for w in whole]


def _roots_above(polynomial: list[int], point: int) -> int:
    """Roots above a point, with their multiplicity, of a polynomial with real roots only."""
    moved = list(polynomial)
    for k in range(len(moved) - 1):
        for j in range(len(moved) - 2, k - 1, -1):
            moved[j] += point * moved[j + 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(polynomial: list[int], point: int) -> int:
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], count: int, trace: int) -> tuple[list[int], int]:
    """The `count` largest positive roots, largest first, as integers scaled by a power of two, and
    that power. A root r is given by the integer at most one above r * 2^power."""
    size = len(polynomial) - 1
    power = max(0, ROOT_BITS - max(1, trace).bit_length())
    scaled = [c << (power * (size - k)) for k, c in enumerate(polynomial)]
    top, found = (trace << power) + 1, []
    positive = _roots_above(scaled, 0)
    for k in range(1, min(count, positive) + 1):
        low, high, above_low, above_high = 0, found[-1] if found else top, positive, 0
        if found:
            above_high = _roots_above(scaled, high)
            if above_high < k <= _roots_above(scaled, high - 1):
                found.append(high)  # as large as the one before, within a unit
                continue
        while high - low > 1:
            middle = (low + high) // 2
            if above_low - above_high == 1:
                # One simple root is left: the sign tells its side.
                above = _sign(scaled, middle)
                above_middle = above_low if above == (-1) ** above_low else above_high
            else:
                above_middle = _roots_above(scaled, middle)
            if above_middle >= k:
                low, above_low = middle, above_middle
            else:
                high, above_high = middle, above_middle
        found.append(high)
    return found, power


def _solver(matrix: np.ndarray):
    """A function that solves matrix * x = b, by elimination with row pivots; an exact zero pivot
    becomes one far below all others."""
    a, size = matrix.copy(), len(matrix)
    tiny = max(1, max(abs(x) for x in a.ravel())) * Decimal(10) ** (10 - DIGITS)
    order = np.arange(size)
    for k in range(size):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1:, k] = a[k + 1:, k] / a[k, k]
        a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.outer(a[k + 1:, k], a[k, k + 1:])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order]
        for k in range(1, size):
            x[k] = x[k] - a[k, :k].dot(x[:k])
        for k in range(size - 1, -1, -1):
            x[k] = (x[k] - a[k, k + 1:].dot(x[k + 1:]) if k + 1 < size else x[k]) / a[k, k]
        return x

    return solve


def vectors(matrix: list[list[int]], roots: list[int], power: int) -> list[list[float]]:
    """A unit vector per root, each at right angles to those before it; equal roots get different ones."""
    size, found = len(matrix), []
    with localcontext() as context:
        context.prec = DIGITS
        whole = np.array([[Decimal(x) for x in row] for row in matrix], object)
        draws = np.random.Generator(np.random.PCG64(1))
        for root in roots:
            moved = whole.copy()
            at = np.arange(size)
            # Half a unit below the bound: never further from the root than the bisection's last step.
            moved[at, at] = moved[at, at] - (Decimal(root) - Decimal("0.5")) / (1 << power)
            solve = _solver(moved)
            x = np.array([Decimal(float(v)) for v in draws.normal(size=size)], object)
            for _ in range(4):
                x = solve(x)
                for other in found:
                    x = x - other * other.dot(x)
                x = x / x.dot(x).sqrt()
            found.append(x)
        return [[float(v) for v in x] for x in found]
