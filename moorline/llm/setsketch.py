"""SetSketch registers of shingle sets: build, band, and estimate two sets jointly.

Each element puts one truncated exponential value into every register: its j-th smallest value
falls into the j-th of m slices of an exponential law, and an own permutation of the registers
says which register gets it. A register keeps the least value, as a whole exponent of ``BASE``.
Registers of a union are the larger exponents of both, so sketches merge; two sets agree in a
register about as often as they share elements.
"""

from __future__ import annotations

import numpy as np

from moorline.llm.words import mix

REGISTERS = 383  # a prime, so that j -> a*j + b permutes the registers
# The chance that banding misses a pair of exactly the wanted similarity stays below this.
MISS = 1e-5
# So fine that registers of sets with nothing in common agree 2 times in 100, and a band of 7 of
# them 1 in 10^12; a byte holds the exponents of sets up to some 10^5 elements. Those of larger
# sets end at 255, which makes more candidates among such sets and loses none.
BASE = 1.08
RATE = 20.0


def _seed(k: int) -> np.uint64:
    return np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))


def _least(elements: np.ndarray, rows: np.ndarray, limits: np.ndarray, out: np.ndarray) -> None:
    """Put every value under its row's limit into ``out`` (rows x registers), keeping the least."""
    first = elements % np.uint64(REGISTERS)
    stride = (elements // np.uint64(REGISTERS)) % np.uint64(REGISTERS - 1) + np.uint64(1)
    limit = limits[rows]
    base = rows.astype(np.int64) * REGISTERS
    flat = out.reshape(-1)
    for j in range(REGISTERS):
        alive = limit > j / REGISTERS
        if not alive.all():
            elements, first, stride, limit, base = (x[alive] for x in (elements, first, stride, limit, base))
        if not len(elements):
            return
        random = (mix(elements + _seed(j + 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        value = (j + random) / REGISTERS
        hit = value < limit
        register = ((first + np.uint64(j) * stride) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(flat, base[hit] + register[hit], value[hit])


def sketches(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Register exponents (rows x registers, bytes) of sets of distinct 64-bit elements.

    Only values that can still be a least one are made: with n elements those under about
    log(m)/n, however large n is. A row where this leaves a register open is made again with
    a limit twice as high, so the registers are those of all values. An empty set has zeros.
    """
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(counts)), counts)
    least = np.full((len(counts), REGISTERS), np.inf)
    todo = np.flatnonzero(counts)
    reach = np.log(REGISTERS) + 4.0
    while len(todo):
        limits = np.zeros(len(counts))
        limits[todo] = 1.0 - np.exp(-reach / counts[todo])
        limits[limits > 1.0 - 1e-9] = 1.1
        chosen = limits[rows] > 0
        _least(elements[chosen], rows[chosen], limits, least)
        todo = todo[np.isinf(least[todo]).any(axis=1)]
        least[todo] = np.inf
        reach *= 2
    with np.errstate(divide="ignore"):
        value = -np.log1p(-np.minimum(least, 1 - 2.0**-53)) / RATE
        exponents = np.floor(1.0 - np.log(value) / np.log(BASE))
    exponents[counts == 0] = 0
    return np.clip(exponents, 0, 255).astype(np.uint8)


def band_width(least: float) -> int:
    """The most registers a band can have so that pairs of similarity ``least`` meet, up to ``MISS``."""
    agree = 1 - 2 * float(_share(np.array((1 - least) / 2)))
    return max(width for width in range(1, 12) if (1 - agree**width) ** (REGISTERS // width) <= MISS)


def band_keys(registers: np.ndarray, width: int) -> np.ndarray:
    """One hash per band of ``width`` registers (rows x bands)."""
    bands = REGISTERS // width
    keys = np.empty((len(registers), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(registers), _seed(band + 1))
        for column in registers[:, band * width:(band + 1) * width].T:
            key = mix(key ^ (column.astype(np.uint64) + np.uint64(1)))
        keys[:, band] = key
    return keys.view(np.int64)


def _share(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set is larger, when that set alone has a share x of the union."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihoods(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Joint log-likelihood (pairs x grid) of each similarity in ``grid``.

    Counts of registers where the first, the second or neither is larger are multinomial, with
    chances set by both sizes and the similarity. A similarity that the sizes rule out has -inf.
    """
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    only_a, only_b = u - v * grid, v - u * grid
    p, q = _share(only_a), _share(only_b)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(k > 0, k * np.log(x), 0.0) for k, x in ((more, p), (less, q), (same, 1 - p - q))]
    out = sum(parts)
    out[(only_a < -1e-12) | (only_b < -1e-12)] = -np.inf
    return out


GRID = np.linspace(0.0, 1.0, 201)


def estimates(a, b, n_a, n_b) -> np.ndarray:
    """The most likely similarity of each pair, to half a hundredth."""
    return GRID[np.argmax(log_likelihoods(a, b, n_a, n_b, GRID), axis=1)]


def plausible(a, b, n_a, n_b, least: float, slack: float = 14.0) -> np.ndarray:
    """Pairs whose similarity may be ``least`` or more.

    A pair goes only if its best similarity from ``least`` on is e^slack times less likely than
    its best one overall, or if the sizes rule it out.
    """
    grid = np.append(GRID, least)
    found = log_likelihoods(a, b, n_a, n_b, grid)
    top = found[:, grid >= least].max(axis=1)
    sized = np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) - 1e-9
    # The likelihood takes values as unrounded; exact agreement at the ends must not count against a pair.
    return sized & (top >= found.max(axis=1) - slack)
