"""Weighted min-hash signatures from darts.

Every element owns the same endless random set of darts, each with a weight coordinate, a
rank and one of ``k`` coordinates of the signature.  A set is hit by the darts that stand
below its elements' weights; the earliest dart of each coordinate is kept.  Two sets agree
in a coordinate with a probability equal to their weighted Jaccard similarity.

Darts are thrown region by region in the order of rank: a region has a Poisson number of
darts, drawn from a hash of the element and the region, so a large set needs few regions and
a set's cost is its size plus about ``k ln k`` darts, not size times ``k``.
"""

from __future__ import annotations

import math

import numpy as np

from tidemark.llm.words import U, Words, grams, mix, uniform

#: Ranks of the first regions: widths double up to 1, later ones have width 1.
_FIRST = -8


def _poisson_steps(mean: float) -> np.ndarray:
    terms = np.cumsum([math.exp(-mean) * mean**i / math.factorial(i) for i in range(24)])
    return terms[: int(np.searchsorted(terms, 1 - 1e-15)) + 1]


def signatures(row: np.ndarray, item: np.ndarray, rows: int, k: int, excess: np.ndarray | None = None) -> np.ndarray:
    """``[rows, k]`` identities of the kept darts; 0 in rows without elements.

    An element of weight ``w`` comes as ``ceil(w)`` items with different hashes; ``excess`` is the
    part of each item's unit weight that the element has (default: all of it).
    """
    rank, kept = np.full(rows * k, np.inf), np.zeros(rows * k, U)
    open_rows = np.zeros(rows, bool)
    open_rows[row] = True
    low, width, level = 0.0, 2.0**_FIRST, 0
    while open_rows.any():
        mine = np.flatnonzero(open_rows[row])
        # Unit regions come in blocks that double, as only small sets get here.
        regions = max(1, int(low)) if width == 1.0 else 1
        number = np.searchsorted(steps := _poisson_steps(width), uniform(
            mix((item[mine][:, None] + (U(level) + np.arange(regions, dtype=U))[None, :] * U(0x9E3779B97F4A7C15)).ravel(), 21)), "right")
        number = np.minimum(number, len(steps))
        cell = np.repeat(np.arange(len(number)), number)
        place = np.arange(len(cell)) - np.repeat(np.cumsum(number) - number, number)
        source, region = mine[cell // regions], cell % regions
        dart = mix(item[source] ^ mix((U(level) + region.astype(U)) * U(4096) + place.astype(U), 22), 23)
        at = low + width * (region + uniform(mix(dart, 24)))
        if excess is not None:
            under = uniform(mix(dart, 25)) < excess[source]
            dart, at, source = dart[under], at[under], source[under]
        key = row[source] * k + (dart % U(k)).astype(np.int64)
        np.minimum.at(rank, key, at)
        first = rank[key] == at
        kept[key[first]] = dart[first]
        open_rows &= np.isinf(rank.reshape(rows, k)).any(axis=1)
        low, level = low + width * regions, level + regions
        width = min(1.0, low)
    return kept.reshape(rows, k)


def shingles(words: Words, rows: int, n: int, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of each row's distinct runs of ``n`` words; a shorter text is one run.

    With ``counted`` a run that occurs ``c`` times gives ``c`` items, as an element of weight ``c``.
    """
    item, row = [], []
    runs = grams(words.hash, n)
    if len(runs):
        inside = words.inside(n)
        item.append(runs[inside])
        row.append(words.row[: len(runs)][inside])
    length = np.diff(words.first)
    for m in range(1, n):
        short = np.flatnonzero(length == m)
        if len(short):
            item.append(grams(words.hash, m)[words.first[short]])
            row.append(short)
    if not item:
        return np.zeros(0, np.int64), np.zeros(0, U)
    items, of = np.concatenate(item), np.concatenate(row)
    order = np.lexsort((items, of))
    items, of = items[order], of[order]
    new = np.concatenate([[True], (items[1:] != items[:-1]) | (of[1:] != of[:-1])])
    if not counted:
        return of[new], items[new]
    place = np.arange(len(items)) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(items))))
    return of, np.where(place > 0, mix(items + place.astype(U) * U(0x9E3779B97F4A7C15), 26), items)


def set_identity(row: np.ndarray, item: np.ndarray, rows: int) -> np.ndarray:
    """``[rows, 2]``: 128 bits that sets share only when they are equal; 0 for an empty set."""
    out = np.zeros((rows, 2), U)
    for side in (0, 1):
        np.add.at(out[:, side], row, mix(item, 27 + side))
    return out


def band_hashes(kept: np.ndarray, bands: int, size: int) -> np.ndarray:
    """``[rows, bands]``: one hash for each band of ``size`` coordinates, the band's number mixed in."""
    parts = kept[:, : bands * size].reshape(len(kept), bands, size)
    out = np.zeros(parts.shape[:2], U)
    for j in range(size):
        out = mix(out ^ parts[:, :, j], 31)
    return mix(out + np.arange(bands, dtype=U)[None, :], 32)
