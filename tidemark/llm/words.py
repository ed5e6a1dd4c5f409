"""Words of a whole Arrow batch at once, as byte spans and 64-bit hashes.

Work is vectorised over a batch of documents; a batch is cut into slices of about a
megabyte of text so that memory does not depend on how many rows Spark sends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BYTE = np.random.RandomState(20240131).randint(1, 2**63 - 1, 256).astype(U) * U(2) + U(1)
_STEP = U(0x9E3779B97F4A7C15)
_FAR = U(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[U(1)], np.full(n - 1, base, U)]), dtype=U)


_NEAR_POWERS = _powers(_STEP, 1024)
#: Bytes that are hashed at a time, and the powers and inverse powers for their places.
_BLOCK = 1 << 15
_PLACE_POWERS, _PLACE_INVERSE = _powers(_STEP, _BLOCK + 1024), _powers(U(pow(int(_STEP), -1, 2**64)), _BLOCK + 1024)
#: Byte classes: everything but space and tab to carriage return; lower-case letters, digits and non-ASCII bytes.
NOT_SPACE = np.array([b != 0x20 and not 9 <= b <= 13 for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h + U((salt * 0xA24BAED4963EE407 + 0x632BE59BD9B4E019) % 2**64)
    h = (h ^ (h >> U(32))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(29))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(32))


def uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (h >> U(11)).astype(np.float64) * 2.0**-53


@dataclass
class Words:
    """Words of a slice: ``data`` its bytes, word ``i`` is ``data[start[i]:end[i]]`` of row ``row[i]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # first[r]:first[r + 1] are the words of row r
    hash: np.ndarray

    def inside(self, n: int) -> np.ndarray:
        """For each place where ``n`` words fit: whether they belong to one row."""
        return self.row[: max(0, len(self.row) - n + 1)] == self.row[n - 1 :]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row; a null has none."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text; a longer row is a piece of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def split_words(column: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes of a class; ``lower`` folds A to Z first."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    member = kind[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    edges = offsets[offsets < n]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(member & ~before)
    end = np.flatnonzero(member & ~after) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)))
    return Words(data, start, end, row, first, hashes(data, start, end))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word ``data[start:end]``; the words are in the order of their places.

    That is the sum of its bytes' numbers times powers of their places in the word: differences
    of running sums over a block, brought back to the word's first place.
    """
    length, out = end - start, np.empty(len(start), U)
    cuts = np.searchsorted(start, np.arange(0, len(data) + _BLOCK, _BLOCK)).tolist()
    for block, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            begin = block * _BLOCK
            terms = _BYTE[data[begin : begin + _BLOCK + 1024]]
            terms *= _PLACE_POWERS[: len(terms)]
            sums = np.zeros(len(terms) + 1, U)
            np.cumsum(terms, out=sums[1:])
            first = start[a:b] - begin
            out[a:b] = (sums[np.minimum(end[a:b] - begin, len(terms))] - sums[first]) * _PLACE_INVERSE[first]
    for i in np.flatnonzero(length > 1024).tolist():
        place = np.arange(length[i])
        far = _powers(_FAR, (int(length[i]) >> 10) + 1)
        out[i] = (_BYTE[data[start[i] : end[i]]] * _NEAR_POWERS[place & 1023] * far[place >> 10]).sum(dtype=U)
    return mix(out + length.astype(U))


def grams(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive hashes, whatever row they belong to."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, U)
    base = mix(hashes, salt)
    out, done = np.zeros(total, U), 0
    block, size, step = base, 1, int(_STEP)
    rest = n
    # Binary powers: `block` holds the hash of every run of `size` words.
    while rest:
        if rest & 1:
            out = out * U(step) + block[done : done + total]
            done += size
        rest >>= 1
        if rest:
            block = block[:-size] * U(step) + block[size:]
            size, step = size * 2, step * step % 2**64
    return mix(out + U(n), salt)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the place of its lowest one, the leftmost of equals."""
    total = len(values) - width + 1
    if total <= 0:
        return np.zeros(0, np.int64)
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = place[:-step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        size += step
    return place
