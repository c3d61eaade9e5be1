r"""Byte-pair encoding by an index of pair occurrences, and decoding.

All different pieces of a partition are encoded together. The index maps each merge rank to every
place where its pair stands. Ranks are applied in ascending order: one rank merges all of its places
at once, and only the neighbours of those places change, so only their lists are updated. No piece
is scanned again for its lowest pair. A rank that appears nowhere costs nothing.

Whole texts are cut into units whose tokens do not depend on their surroundings, and each task
gathers the different units of its texts before it encodes them. ``UNITS`` bounds what a worker
holds; it is emptied when full, which changes no result.

Defined cases: a null text is empty and has no tokens; repeated rows are encoded each; other columns
take no part; an empty table gives no rows. Strings of added tokens in a text become those tokens,
as in the library's default.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import chunks, filled, ship
from .vocabularies import vocabulary

UNITS = 250_000
PENDING_BYTES = 48_000_000

ROWS = "doc_id long, n_tokens long, ids string, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class PairIndex:
    """Merge rules of a vocabulary, and their application to many pieces at once."""

    def __init__(self, first: np.ndarray, left: list[int], right: list[int], made: list[int]):
        self.first = first
        self.left, self.right, self.made = left, right, made
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        # Of a pair that is listed twice the first counts.
        self.keys, self.ranks = np.unique(keys, return_index=True)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and the ids of all pieces one after the other."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbol = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbol)
        ends = np.cumsum(sizes)
        after = np.arange(1, n + 1, dtype=np.int64)
        before = np.arange(-1, n - 1, dtype=np.int64)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def file(places: np.ndarray) -> None:
            ranks = self.rank_of(symbol[places], symbol[after[places]])
            known = ranks >= 0
            places, ranks = places[known], ranks[known]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            edges = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            for rank, a, b in zip(ranks[edges].tolist(), edges.tolist(), [*edges[1:], len(ranks)]):
                if rank in index:
                    index[rank].append(places[a:b])
                else:
                    index[rank] = [places[a:b]]
                    heapq.heappush(active, rank)

        file(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right = self.left[rank], self.right[rank]
            then = after[places]
            # Where one of the two has been merged meanwhile, the pair is not there any more.
            good = alive[places] & (symbol[places] == left) & (then >= 0) & (symbol[then] == right)
            places, then = places[good], then[good]
            if left == right and len(places) > 1:
                places = apart(places, then)
                then = after[places]
            if not len(places):
                continue
            beyond = after[then]
            symbol[places] = self.made[rank]
            alive[then] = False
            after[places] = beyond
            goes_on = beyond >= 0
            before[beyond[goes_on]] = places[goes_on]
            previous = before[places]
            changed = np.concatenate([previous[previous >= 0], places[goes_on]])
            if len(changed):
                file(np.unique(changed))
        piece = np.repeat(np.arange(len(pieces)), sizes)[alive]
        return np.bincount(piece, minlength=len(pieces)), symbol[alive].astype(np.int64)


def apart(places: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Of places of a pair of equal symbols, from the left, those that do not share a symbol."""
    kept, taken = [], -1
    for place, following in zip(places.tolist(), then.tolist()):
        if place != taken:
            kept.append(place)
            taken = following
    return np.array(kept, np.int64)


class Codec:
    """A byte-level vocabulary file: text to ids and back, unit by unit."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        ids = described["model"]["vocab"]
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        self.index = PairIndex(
            np.array([ids[x] for x in letters], np.int64),
            [ids[a] for a, _ in pairs],
            [ids[b] for _, b in pairs],
            [ids[a + b] for a, b in pairs],
        )
        byte = {x: b for b, x in enumerate(letters)}
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.bytes = {
            i: t.encode() if t in self.added else bytes(byte[x] for x in t) for t, i in ids.items()
        } | {i: t.encode() for t, i in self.added.items()}
        self.pieces_in = regex.compile(PATTERN).findall
        self.uneven = regex.compile(r"\s\s|\x00").search
        self.special = regex.compile("|".join(f"({regex.escape(t)})" for t in self.added) or "(?!)")
        self.rows: dict[str, int] = {}
        self.empty()

    def empty(self) -> None:
        self.rows.clear()
        self.fresh: list[str] = []
        self.sizes: list[int] = []
        self.written: list[str] = []
        self.decoded: list[bytes] = []

    def units(self, text: str) -> list[str]:
        """Parts that are encoded alike wherever they stand. Joined, they are the text."""
        if any(t in text for t in self.added):
            parts = [p for p in self.special.split(text) if p]
            return [u for p in parts for u in ([p] if p in self.added else self.units(p))]
        if self.uneven(text):
            return self.pieces_in(text)
        # White space comes one by one here: a blank goes with what follows, a line end alone.
        marked = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")
        return [u for u in marked.split("\x00") if u]

    def row(self, unit: str) -> int:
        found = self.rows.get(unit)
        if found is None:
            found = self.rows[unit] = len(self.rows)
            self.fresh.append(unit)
        return found

    def learn(self) -> None:
        """Encode all units that are new since the last time."""
        pieces: dict[str, int] = {}
        of: list[list[int]] = []
        for unit in self.fresh:
            inside = [] if unit in self.added else self.pieces_in(unit)
            of.append([pieces.setdefault(p, len(pieces)) for p in inside])
        sizes, ids = self.index.encode([p.encode() for p in pieces])
        ids, edges = ids.tolist(), np.r_[0, np.cumsum(sizes)].tolist()
        for unit, inside in zip(self.fresh, of):
            if unit in self.added:
                own = [self.added[unit]]
            else:
                own = [i for p in inside for i in ids[edges[p] : edges[p + 1]]]
            self.sizes.append(len(own))
            self.written.append(",".join(map(str, own)))
            self.decoded.append(b"".join(map(self.bytes.__getitem__, own)))
        self.fresh = []


_codecs: dict[str, Codec] = {}


def encoder(path: str, finish, names: list[str]):
    """Arrow batches of texts -> id, token count and what ``finish`` makes of ids and text."""

    def run(batches):
        if path not in _codecs:
            _codecs[path] = Codec(path)
        codec = _codecs[path]
        waiting, held = [], 0

        def done():
            codec.learn()
            for docs, texts in waiting:
                counts, made = [], []
                for rows in texts:
                    counts.append(sum(map(codec.sizes.__getitem__, rows)))
                    made.append(
                        finish(
                            ",".join(map(codec.written.__getitem__, rows)),
                            b"".join(map(codec.decoded.__getitem__, rows)).decode("utf-8", "replace"),
                        )
                    )
                ids, decoded = zip(*made)
                yield pa.record_batch(
                    [docs, pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=names,
                )
            waiting.clear()
            if len(codec.rows) > UNITS:
                codec.empty()

        for batch in batches:
            column = filled(batch.column("text"))
            for at, stop in chunks(column):
                texts = [list(map(codec.row, codec.units(t))) for t in column[at:stop].to_pylist()]
                waiting.append((batch.column("doc_id")[at:stop], texts))
                held += sum(map(len, texts))
                if held * 8 > PENDING_BYTES or len(codec.fresh) > UNITS:
                    yield from done()
                    held = 0
        if waiting:
            yield from done()

    return run


def as_texts(ids: str, text: str) -> tuple[str, str]:
    return ids, text


def as_digests(ids: str, text: str) -> tuple[str, str]:
    return hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def encode(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Ids of each text (decimal, joined by commas), how many, and the text decoded from them."""
    ship(documents.sparkSession)
    names = ["doc_id", "n_tokens", "ids", "decoded"]
    run = encoder(vocabulary(tokenizer), as_texts, names)
    return documents.select("doc_id", "text").mapInArrow(run, ROWS)


def op10_byte_pairs(spark, sf_dir: str) -> DataFrame:
    """``encode`` with each text and id list as its digest, made where they are."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ship(spark)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    run = encoder(vocabulary("byte_bpe_50k.json"), as_digests, names)
    return documents.select("doc_id", "text").mapInArrow(run, DIGESTS)
