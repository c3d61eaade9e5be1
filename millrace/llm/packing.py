"""Packing of token sequences: bounded-space online best fit over a bitset of free space.

A packer keeps a fixed number of open sequences. They are filed by their free space, and one big
integer has a bit for each free space that some open sequence has, so the tightest fit for a piece
is the lowest bit from the piece's length up: one shift, however many sequences are open. Where none
fits, a new one is opened; if that is one too many, the fullest is closed.

Texts are read once. What goes on to packing is a few numbers for each piece, dealt out evenly by a
hash into groups of about ``GROUP`` pieces. A group's pieces come longest first, and about as many
sequences can be open as a group has pieces, so a group wastes less than one sequence as long as it
has short pieces to fill up with.

Defined cases: a null text is the empty text, whose only token is the end token; repeated rows are
documents of their own; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .textkit import chunks, filled, rested, ship
from .vocabularies import vocabulary, word_vocabulary

LENGTH = 2048
END = 0
OPEN = 16_384
GROUP = 16_384

PIECE_ROWS = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PLACE_ROWS = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long"
)


class BestFit:
    """Open sequences of one packer. ``place`` returns the sequence and the place in it."""

    def __init__(self, length: int = LENGTH, most_open: int = OPEN):
        self.length, self.most_open = length, most_open
        self.free = 0
        self.at: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = self.begun = 0
        self.closed: list[tuple[int, int]] = []

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            sequence = self.take(space)
        else:
            if self.open == self.most_open:
                fullest = (self.free & -self.free).bit_length() - 1
                self.closed.append((self.take(fullest), fullest))
            sequence, space = self.begun, self.length
            self.begun += 1
        left = space - size
        if left:
            self.at[left].append(sequence)
            self.free |= 1 << left
            self.open += 1
        return sequence, self.length - space

    def take(self, space: int) -> int:
        sequence = self.at[space].pop()
        if not self.at[space]:
            self.free ^= 1 << space
        self.open -= 1
        return sequence


def token_pieces(path: str, length: int, end: int):
    """Arrow batches of texts -> one row for each piece of at most ``length`` tokens."""

    def run(batches):
        cache = word_vocabulary(path)
        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                counts, ids = cache.tokens(column[at:stop].to_pylist())
                rows: list[tuple] = []
                edges = np.r_[0, np.cumsum(counts)]
                for i in range(stop - at):
                    own = np.empty(counts[i] + 1, "<u4")
                    own[:-1] = ids[edges[i] : edges[i + 1]]
                    own[-1] = end
                    doc = batch.column("doc_id")[at + i].as_py()
                    for piece, start in enumerate(range(0, len(own), length)):
                        part = own[start : start + length]
                        rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
                columns = list(zip(*rows))
                # Where two rows are alike in all else, this tells them apart.
                columns.append(range(len(rows)))
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, PIECES.types)], schema=PIECES
                )

    return run


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("row", pa.int64()),
    ]
)
PLACES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def packer(length: int, most_open: int):
    """The pieces of one group -> their places in its sequences."""

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        columns = {n: table.column(n).combine_chunks() for n in PIECES.names}
        sizes = columns["length"].to_numpy()
        ids = columns["doc_id"].fill_null(-1).to_numpy()
        order = np.lexsort(
            (columns["row"].to_numpy(), columns["piece"].to_numpy(), ids, -sizes)
        )
        fit = BestFit(length, most_open)
        sequence = np.zeros(len(sizes), np.int64)
        offset = np.zeros(len(sizes), np.int64)
        for i in order.tolist():
            sequence[i], offset[i] = fit.place(int(sizes[i]))
        columns |= {"sequence_id": pa.array((group << 32) + sequence), "offset": pa.array(offset)}
        return pa.table({n: columns[n] for n in PLACES.names}, schema=PLACES)

    return run


def pack(
    documents: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    length: int = LENGTH,
    end: int = END,
    most_open: int = OPEN,
    group: int = GROUP,
) -> DataFrame:
    """One row for each piece of a text: which ids it has, and where it stands in which sequence."""
    ship(documents.sparkSession)
    pieces = durable(
        documents.select("doc_id", "text").mapInArrow(
            rested(token_pieces(vocabulary(tokenizer), length, end)), PIECE_ROWS
        ),
        "pieces",
    )
    groups = max(1, round(pieces.count() / group))
    key = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("group")
    return (
        pieces.select("*", key)
        .groupBy("group")
        .applyInArrow(packer(length, most_open), PLACE_ROWS)
    )


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
