"""Special functions on numpy arrays, used inside Arrow batches."""

from __future__ import annotations

import numpy as np

_SHIFT = 10


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for positive x: shift above 10, then the Stirling series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(_SHIFT):
        low = z < _SHIFT
        if not low.any():
            break
        shift = np.where(low, shift + np.log(np.where(low, z, 1.0)), shift)
        z = np.where(low, z + 1.0, z)
    r = 1.0 / (z * z)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - shift


def digamma(x: np.ndarray) -> np.ndarray:
    z = np.asarray(x, dtype=float).copy()
    out = np.zeros_like(z)
    for _ in range(_SHIFT):
        low = z < _SHIFT
        out = np.where(low, out - 1.0 / np.where(low, z, 1.0), out)
        z = np.where(low, z + 1.0, z)
    r = 1.0 / (z * z)
    return out + np.log(z) - 0.5 / z - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))


def trigamma(x: np.ndarray) -> np.ndarray:
    z = np.asarray(x, dtype=float).copy()
    out = np.zeros_like(z)
    for _ in range(_SHIFT):
        low = z < _SHIFT
        out = np.where(low, out + 1.0 / np.where(low, z * z, 1.0), out)
        z = np.where(low, z + 1.0, z)
    r = 1.0 / (z * z)
    return out + 1.0 / z + 0.5 * r + r / z * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series for 0 <= z < 1, summed until the terms vanish."""
    a, b, c, z = np.broadcast_arrays(*[np.asarray(v, dtype=float) for v in (a, b, c, z)])
    term = np.ones(a.shape)
    total = np.ones(a.shape)
    for k in range(100_000):
        term = term * (a + k) * (b + k) / ((c + k) * (k + 1)) * z
        total = total + term
        if np.all(np.abs(term) <= 1e-14 * np.abs(total)):
            return total
    raise ArithmeticError("the series does not converge")


def _log1p_rest(x: np.ndarray) -> np.ndarray:
    """log(1 + x) - x + x^2 / 2 for x >= 0, without cancellation."""
    small = np.minimum(x, 0.125)
    total, power = np.zeros_like(x), small**3
    for n in range(3, 24):
        total = total + (power / n if n % 2 else -power / n)
        power = power * small
    return np.where(x < 0.125, total, np.log1p(x) - x + x * x / 2)


#: Last terms of a tie sum that are added one by one, where the integral of the others would meet the pole.
_LAST = 32


def tie_sums(at_risk: np.ndarray, dying: np.ndarray, deaths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums over l = 0 .. d-1 of log(phi), 1/phi, l/phi, 1/phi^2, l/phi^2, l^2/phi^2.

    phi = at_risk - (l / d) * dying, the Efron weight of tied deaths. For any number of ties the last ``_LAST`` terms are
    added one by one and those before them by the midpoint form of the Euler-Maclaurin formula with three corrections;
    phi, in units of dying / d, is at least ``_LAST`` there, so the next correction is below 1e-14 of the sum. Integrals are
    written in log(1 + x) less its first terms, so nothing cancels where few of very many die.
    """
    s, t, d = (np.asarray(v, dtype=float) for v in (at_risk, dying, deaths))
    k = d / t
    u = np.maximum(s * k, d)
    last = d[:, None] - 1 - np.arange(_LAST)
    there = last >= 0
    l = np.where(there, last, 0.0)
    v = np.where(there, u[:, None] - l, 1.0)
    add = lambda terms: np.where(there, terms, 0.0).sum(axis=1)
    tail = (add(np.log(v)), add(1 / v), add(l / v), add(1 / v**2), add(l / v**2), add(l**2 / v**2))

    n = np.maximum(d - _LAST, 0.0)
    low, high = u - n + 0.5, u + 0.5
    x = n / low
    rest = _log1p_rest(x)
    log = np.log1p(x)
    less = rest - x * x / 2  # log(1 + x) - x
    integrals = (
        low * less + n * np.log(high),
        log,
        low * less + (n - 0.5) * log,
        n / (low * high),
        -less - n / (2 * low * high),
        n * x * x - x * x / 2 + n / (4 * low * high) - 2 * u * rest,
    )

    def slopes(at: np.ndarray) -> tuple[tuple[np.ndarray, ...], ...]:
        """First, third and fifth derivatives by l of the six terms, where phi is ``at``."""
        i = u - at
        return (
            (-1 / at, -2 / at**3, -24 / at**5),
            (1 / at**2, 6 / at**4, 120 / at**6),
            (u / at**2, 6 * u / at**4, 120 * u / at**6),
            (2 / at**3, 24 / at**5, 720 / at**7),
            ((u + i) / at**3, 6 * (3 * u + i) / at**5, 120 * (5 * u + i) / at**7),
            (2 * i * u / at**3, 12 * u * (u + i) / at**5, 240 * u * (2 * u + i) / at**7),
        )

    out = []
    for integral, end, begin, more in zip(integrals, slopes(low), slopes(high), tail, strict=True):
        change = [a - b for a, b in zip(end, begin, strict=True)]
        out.append(integral - change[0] / 24 + change[1] * 7 / 5760 - change[2] * 31 / 967680 + more)
    logs, f1, fl, q1, ql, q2 = out
    return logs - d * np.log(k), k * f1, k * fl, k**2 * q1, k**2 * ql, k**2 * q2
