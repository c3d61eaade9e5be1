"""Words of whole texts as numpy arrays: their places, their hashes, and hashes of word windows.

Everything works on one Arrow column at a time, straight on its UTF-8 bytes. A hash of a word or of
a window depends only on its bytes, never on the batch, task or process that computes it.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from inspect import signature
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Temporary arrays take some 60 times this much.
CHUNK_BYTES = 250_000
#: A few chunks of texts.
BATCH_ROWS = 1000
U = np.uint64

_BASE = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5]
_inverse = [pow(b, -1, 1 << 64) for b in _BASE]
_powers: dict[tuple[int, bool], np.ndarray] = {}

BYTE_CODES = np.random.Generator(np.random.PCG64(20_240_601)).integers(
    1, 1 << 63, 256, dtype=np.uint64
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes outside ``[^\x20\x09-\x0D]``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also where only the driver has it on its path."""
    root = Path(__file__).resolve().parents[2]
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(root) in paths or Path.cwd() == root or getattr(spark, "_millrace_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted((root / "millrace").rglob("*.py")):
            archive.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(target)
    spark._millrace_shipped = True


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches of whole texts hold a thousand rows, not Spark's ten thousand.

    A batch is held by the JVM while it is filled and by the worker while it is read, for every task of an
    executor. Spark reads the setting when a query runs, so it stays for the session; a smaller one wins.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def rested(run):
    """A task's function that gives back at its end what its worker would keep in reserve.

    Workers outlive tasks, and several of them share an executor's memory.
    """

    def single(rows):
        made = run(rows)
        if isinstance(made, Iterator):
            return drained(made)
        rest()
        return made

    def paired(rows, others):
        made = run(rows, others)
        rest()
        return made

    def drained(made):
        yield from made
        rest()

    # Spark tells grouped from cogrouped functions by how many arguments they take.
    return paired if len(signature(run).parameters) == 2 else single


def rest() -> None:
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library keeps its reserve


def powers(kind: int, inverse: bool, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n at least."""
    have = _powers.get((kind, inverse))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, _inverse[kind] if inverse else _BASE[kind], U)
        steps[0] = 1
        have = _powers[kind, inverse] = np.cumprod(steps, dtype=U)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def filled(column: pa.Array) -> pa.Array:
    """The texts as 64-bit Arrow strings; null is the empty text."""
    return pc.fill_null(column, "").cast(pa.large_string())


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer text."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a ``filled`` column and where each text begins and ends in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of some texts in reading order. ``first[d]``: how many words texts before d have."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(
    data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES, lower: bool = False
) -> Words:
    """Runs of bytes that are not ``spaces``; a run never goes over the end of a text."""
    inside = ~spaces[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[begins[begins > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    codes = (BYTE_CODES[LOWER] if lower else BYTE_CODES)[data]
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(codes * powers(0, False, len(data) + 1)[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(0, True, len(data) + 1)[starts])
    return Words(starts, ends, np.searchsorted(starts, offsets), hashes)


def window_hashes(words: Words, size: int, kind: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of ``size`` words inside one text, in reading order."""
    n = len(words.hashes)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U)
    text = words.text
    at = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])
    sums = np.zeros(n + 1, U)
    np.cumsum(words.hashes * powers(kind, False, n + 1)[:n], out=sums[1:])
    return at, mixed((sums[at + size] - sums[at]) * powers(kind, True, n + 1)[at] + U(size))


def packed(keys: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each 64-bit key."""
    return np.ascontiguousarray(
        keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    ).tobytes()


def unpacked(blob: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(blob) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return wide.view("<u8").reshape(-1).astype(U)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)
