"""Exact algebra of a whole-number symmetric matrix: polynomial, real roots, null-space vectors.

Polynomials are lists of whole numbers, highest power first.
"""

from __future__ import annotations

from math import comb, gcd, isqrt

import numpy as np

#: Of a root and of a vector's components, bits after the point.
ROOT_BITS = 320
VECTOR_BITS = 448


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2**32."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 7, 61):
        x = pow(base, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2**31 whose product has more than ``bits`` bits."""
    found, n, have = [], (1 << 31) - 1, 0
    while have <= bits:
        if is_prime(n):
            found.append(n)
            have += 30
        n -= 2
    return found


def coefficient_bits(size: int, trace: int) -> int:
    """Of the largest coefficient that a matrix without negative eigenvalues can have, by its trace."""
    bound = 1
    for k in range(1, size + 1):
        bound = max(bound, comb(size, k) * -(-(trace**k) // size**k))
    return bound.bit_length()


def characteristic(matrix: np.ndarray, p: int) -> list[int]:
    """Characteristic polynomial modulo the prime ``p`` by reduction to Hessenberg form."""
    n = len(matrix)
    h = (matrix % p).astype(np.int64)
    for c in range(n - 2):
        below = np.flatnonzero(h[c + 1 :, c])
        if not len(below):
            continue
        r = c + 1 + int(below[0])
        if r != c + 1:
            h[[r, c + 1]] = h[[c + 1, r]]
            h[:, [r, c + 1]] = h[:, [c + 1, r]]
        f = h[c + 2 :, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2 :] = (h[c + 2 :] - f[:, None] * h[c + 1]) % p
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2 :] * f % p).sum(axis=1)) % p
    # Leading blocks one after the other; powers from the lowest here.
    polys = [np.array([1], np.int64)]
    for k in range(n):
        poly = np.zeros(k + 2, np.int64)
        poly[1:] = polys[k]
        poly[:-1] = (poly[:-1] - h[k, k] * polys[k]) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            part = int(h[i, k]) * below % p
            poly[: i + 1] = (poly[: i + 1] - part * polys[i]) % p
        polys.append(poly % p)
    return polys[n][::-1].tolist()


def combined(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The polynomial with these residues whose coefficients are smallest in size."""
    modulus, values = 1, [0] * len(residues[0][1])
    for p, residue in residues:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, residue)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def derivative(poly: list[int]) -> list[int]:
    n = len(poly) - 1
    return [c * (n - i) for i, c in enumerate(poly[:-1])]


def primitive(poly: list[int]) -> list[int]:
    at = next((i for i, c in enumerate(poly) if c), len(poly))
    poly = poly[at:]
    divisor = gcd(*poly) if poly else 1
    return [c // divisor for c in poly] if not poly or poly[0] > 0 else [-c // divisor for c in poly]


def common(a: list[int], b: list[int]) -> list[int]:
    """The greatest common divisor, primitive."""
    a, b = primitive(a), primitive(b)
    while b:
        while len(a) >= len(b):
            lead = a[0]
            a = [c * b[0] for c in a]
            for i, c in enumerate(b):
                a[i] -= lead * c
            a = primitive(a)
            if not a:
                break
        a, b = b, a
    return a


def quotient(a: list[int], b: list[int]) -> list[int]:
    """a / b where b, primitive, divides a."""
    a, found = list(a), []
    while len(a) >= len(b):
        found.append(a[0] // b[0])
        for i, c in enumerate(b):
            a[i] -= found[-1] * c
        a = a[1:]
    return found


def square_free(poly: list[int]) -> list[tuple[list[int], int]]:
    """Factors without repeated roots and how often each one's roots are repeated."""
    factors = []
    shared = common(poly, derivative(poly))
    rest = quotient(poly, shared)
    times = 1
    while len(rest) > 1:
        more = common(rest, shared)
        alone = quotient(rest, more)
        if len(alone) > 1:
            factors.append((primitive(alone), times))
        rest, shared, times = more, quotient(shared, more), times + 1
    return factors


def repeats(poly: list[int], p: int = (1 << 31) - 1) -> bool:
    """Whether some root may be repeated; False is certain."""
    a, b = [c % p for c in poly], [c % p for c in derivative(poly)]
    while any(b):
        while b and not b[0]:
            b = b[1:]
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            f = a[0] * inverse % p
            a = [(c - f * d) % p for c, d in zip(a, b)] + a[len(b) :]
            a = a[1:]
        a, b = b, a
    return len(a) > 1


def roots_above(poly: list[int], t: int) -> int:
    """How many roots are above t, all roots being real: sign changes of the polynomial moved by t."""
    moved = list(poly)
    for end in range(len(moved), 1, -1):
        for i in range(1, end):
            moved[i] += t * moved[i - 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    return [c << (bits * i) for i, c in enumerate(poly)]


def sign_at(poly: list[int], t: int, bits: int) -> int:
    """Of the value at t / 2**bits."""
    value, shift = 0, 0
    for c in poly:
        value = value * t + (c << shift)
        shift += bits
    return (value > 0) - (value < 0)


def isolated(poly: list[int], top: int) -> list[tuple[int, int, int]]:
    """The ``top`` largest positive roots of a polynomial of different roots, none negative, falling.

    Each is ``low, high, bits``: it alone lies above ``low / 2**bits`` and not above ``high / 2**bits``.
    """
    bound = 1 << (-(poly[1] // poly[0])).bit_length()  # their sum, as none is negative
    found = []
    waiting = [(0, bound, 0, roots_above(poly, 0), 0)]
    cache = {0: poly}
    while waiting and len(found) < top:
        low, high, bits, above_low, above_high = waiting.pop()
        n = above_low - above_high
        if n == 1:
            found.append((low, high, bits))
        elif n > 1:
            if high - low == 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
                if bits not in cache:
                    cache = {bits: scaled(poly, bits)}
            if bits not in cache:
                cache[bits] = scaled(poly, bits)
            half = (low + high) // 2
            above = roots_above(cache[bits], half)
            waiting += [(low, half, bits, above_low, above), (half, high, bits, above, above_high)]
    return found


def refined(poly: list[int], low: int, high: int, bits: int, to: int = ROOT_BITS) -> int:
    """The root in that interval times 2**to, rounded down, or the root itself where it is met."""
    if bits > to:  # closer to its neighbour than this tells apart
        return low >> (bits - to)
    low, high = low << (to - bits), high << (to - bits)
    after = sign_at(poly, high, to)
    if after == 0:
        return high
    while high - low > 1:
        half = (low + high) // 2
        sign = sign_at(poly, half, to)
        if sign == 0:
            return half
        low, high = (low, half) if sign == after else (half, high)
    return low


def largest_roots(poly: list[int], top: int) -> list[tuple[list[int], tuple[int, int, int], int]]:
    """Intervals of the ``top`` largest positive roots of each factor, with factor and multiplicity."""
    while poly[-1] == 0:
        poly = poly[:-1]
    if len(poly) == 1:
        return []
    factors = square_free(poly) if repeats(poly) else [(poly, 1)]
    return [(factor, place, times) for factor, times in factors for place in isolated(factor, top)]


def null_vectors(matrix: np.ndarray, root: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the matrix's eigenvalue ``root / 2**ROOT_BITS``.

    Inverse iteration on numbers with ``VECTOR_BITS`` bits after the point. Pivots that have vanished are
    replaced by the smallest number there is. The largest component of each vector is positive.
    """
    n, f = len(matrix), VECTOR_BITS
    lu = np.array([[int(x) << f for x in row] for row in matrix.tolist()], object).reshape(n, n)
    for i in range(n):
        lu[i, i] -= root << (f - ROOT_BITS)
    order = list(range(n))
    for c in range(n):
        r = max(range(c, n), key=lambda i: abs(lu[i, c]))
        if r != c:
            lu[[c, r]] = lu[[r, c]]
            order[c], order[r] = order[r], order[c]
        if lu[c, c] == 0:
            lu[c, c] = 1
        if c + 1 < n:
            factor = (lu[c + 1 :, c] << f) // lu[c, c]
            lu[c + 1 :, c + 1 :] -= (factor[:, None] * lu[c, c + 1 :][None, :]) >> f
            lu[c + 1 :, c] = factor

    def solved(b):
        x = np.array([b[i] for i in order], object)
        for c in range(n):
            x[c + 1 :] -= (lu[c + 1 :, c] * x[c]) >> f
        for c in range(n - 1, -1, -1):
            x[c] = (x[c] << f) // lu[c, c]
            x[:c] -= (lu[:c, c] * x[c]) >> f
        return x

    def unit(x):
        size = max(max(abs(v) for v in x).bit_length() - 4 * f, 0)
        x = np.array([v >> size for v in x], object)
        return np.array([(int(v) << f) // isqrt(int((x * x).sum())) for v in x], object)

    # Starts in general position: as many as vectors, none of them a multiple of another.
    state, starts = 1, []
    for _ in range(count):
        start = []
        for _ in range(n):
            state = state * 6364136223846793005 % (1 << 64)
            start.append(((state >> 33) - (1 << 30)) << (f - 30))
        starts.append(np.array(start, object))
    vectors = starts
    for _ in range(3):
        made = []
        for x in vectors:
            x = unit(solved(x))
            for _ in range(2):
                for other in made:
                    x = x - ((other * (int((x * other).sum()) >> f)) >> f)
            made.append(unit(x))
        vectors = made
    found = []
    for x in vectors:
        values = [int(v) / (1 << f) for v in x]
        sign = 1.0 if max(values, key=abs) > 0 else -1.0
        found.append([sign * v for v in values])
    return found
