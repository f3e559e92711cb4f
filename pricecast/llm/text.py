"""Words and hashes of whole texts, vectorised over chunks of an Arrow batch.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. All hashes are 64-bit polynomials modulo 2**64 over bytes (or
over the hashes of words), finished by a mixing step, so the hash of any run comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # the work arrays of a chunk take some tens of bytes for each of its bytes
SLICE_ROWS = 512

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the base and of its inverse, modulo 2**64."""
    if kind not in _powers or len(_powers[kind][0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        out = []
        for base in (_BASE[kind], _inverse(_BASE[kind])):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[kind] = (out[0], out[1])
    up, down = _powers[kind]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str) -> np.ndarray:
    """Hash of values[start:end] for every given run."""
    up, down = powers(kind, len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte past the end of every word."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class Chunk:
    """Some whole texts laid end to end with a line feed between them."""

    def __init__(self, first: int, blobs: list[bytes]):
        self.first = first
        self.blobs = blobs
        self.data = np.frombuffer(b"\n".join(blobs), dtype=np.uint8)
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs))
        self.text_ends = np.cumsum(sizes + 1) - 1
        self.text_starts = self.text_ends - sizes

    def words(self):
        """(start, end, hash) of every word and, by text, the first word's number (one more entry at the end)."""
        starts, ends = word_spans(self.data)
        bounds = np.append(np.searchsorted(starts, self.text_starts), len(starts))
        return starts, ends, run_hashes(self.data, starts, ends, "byte"), bounds


def rows_of(column: pa.Array) -> Iterator[bytes | None]:
    """Values of a column, few of them Python objects at a time."""
    for at in range(0, len(column), SLICE_ROWS):
        yield from column.slice(at, SLICE_ROWS).to_pylist()


def chunks(blobs: Iterable[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of about ``limit`` bytes; a longer text is a chunk of its own. Null is the empty text."""
    held: list[bytes] = []
    size = first = 0
    for i, b in enumerate(blobs):
        b = b or b""
        if held and size + len(b) > limit:
            yield Chunk(first, held)
            held, size, first = [], 0, i
        held.append(b)
        size += len(b) + 1
    if held:
        yield Chunk(first, held)


def by_slices(column: pa.Array, fn: Callable[[list], pa.Array]) -> pa.Array:
    """fn over slices of a column, so that few rows at a time are Python objects."""
    parts = [fn(column.slice(at, SLICE_ROWS).to_pylist()) for at in range(0, max(1, len(column)), SLICE_ROWS)]
    return pa.concat_arrays(parts)
