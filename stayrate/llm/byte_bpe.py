"""Byte-level BPE encoding and decoding on length-bucketed numpy matrices.

A text is cut by the tokenizer's pattern. The distinct pieces of a batch are put into padded
matrices, one per length bucket; in each round every row merges its leftmost pair of least rank,
rows without a mergeable pair are compacted away, and the rounds go on until no row is left. Pairs
are looked up in one hashed table: (left id, right id) -> merged id. A piece's ids are kept for
later batches of the same worker up to a bounded number of bytes.

Pieces beyond the widest bucket hold a heap of mergeable pairs instead of a matrix row: the same
merges in the same order, in O(n log n), where a matrix would need n rounds of n columns.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import text_of
from stayrate.llm.flat import Numbers, Strings

#: Widest row of each matrix.
BUCKETS = (4, 8, 12, 16, 24, 32, 48, 64, 128)
#: Cells of one matrix at most, and pieces (and their bytes) whose ids a worker keeps.
CELLS = 1 << 21
KEPT_PIECES, KEPT_BYTES = 600_000, 64 << 20
#: Texts whose pieces are encoded together.
ROWS = 512
#: The same matches by the standard library's faster engine, for texts in whose alphabet (Latin
#: letters without superscript digits and fractions) both engines agree on letters and numbers.
PLAIN = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
    )
}
NOT_PLAIN = re.compile("[^\t\n\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]").search
NONE = np.int64(1) << 40
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """Open addressing on numpy arrays: pair of ids -> id of the merged token, else NONE."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, EMPTY)
        self.values = np.full(1 << bits, NONE)
        slot, rest, self.probes = self._home(keys), np.arange(len(keys)), 0
        while len(rest):
            self.probes += 1
            free = rest[self.keys[slot[rest]] == EMPTY]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], merged[put]
            rest = np.setdiff1d(rest, put, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._home(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != EMPTY)]
        return out


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self._split = ranks, regex.compile(pattern).findall
        self._plain = re.compile(PLAIN[pattern]).findall if pattern in PLAIN else None
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_ids < 0).any():
            raise ValueError("the ranks lack a single byte")
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.table = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        size = max(self.bytes_of) + 1
        self.tokens = Strings([self.bytes_of.get(i, b"") for i in range(size)])
        self.decimals = Strings([b"%d," % i for i in range(size)])
        self.forget()

    def forget(self) -> None:
        self.kept = Numbers()
        self.kept_ids, self.kept_bytes = Strings([], np.int32), 0

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, one after another."""
        if self._plain and not NOT_PLAIN(text):
            return self._plain(text)
        return self._split(text)

    # -- encoding -------------------------------------------------------------------------------
    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most ``width`` bytes each."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[flat]
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        rows = np.arange(len(pieces))
        merged = np.full((len(pieces), max(1, width - 1)), NONE)
        real = np.arange(1, width) < lengths[:, None]
        if width > 1:
            merged[real] = self.table.get(ids[:, :-1][real], ids[:, 1:][real])
        while len(rows):
            at = merged.argmin(axis=1)  # the leftmost of the least ranks
            every = np.arange(len(rows))
            best = merged[every, at]
            done = best == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    out[rows[r]] = ids[r, : lengths[r]].copy()
                go = ~done
                rows, ids, merged, lengths = rows[go], ids[go], merged[go], lengths[go]
                at, best, every = at[go], best[go], np.arange(int(go.sum()))
                if not len(rows):
                    break
                width = int(lengths.max())
                ids, merged = ids[:, :width], merged[:, : max(1, width - 1)]
            # Close the gap behind the merged pair, then look up its two new neighbours.
            source = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            ids = np.concatenate(
                (np.take_along_axis(ids, source, 1), np.full((len(rows), 1), -1, np.int64)), 1
            )
            ids[every, at] = best
            lengths = lengths - 1
            links = np.arange(merged.shape[1])
            source = np.minimum(links + (links >= at[:, None]), merged.shape[1] - 1)
            merged = np.take_along_axis(merged, source, 1)
            merged[:, -1] = NONE
            for left in (at - 1, at):
                ok = (left >= 0) & (left + 1 < lengths)
                r, c = every[ok], left[ok]
                merged[r, c] = self.table.get(ids[r, c], ids[r, c + 1])
        return out

    def _heap(self, piece: bytes) -> np.ndarray:
        """Ids of a long piece: the least rank first, the leftmost of equals."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.table.get(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first < NONE)]
        heapq.heapify(heap)
        token = ids.tolist()
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        ranks, text = self.ranks, self.bytes_of

        def pair(i: int) -> int | None:
            j = after[i]
            return ranks.get(text[token[i]] + text[token[j]]) if j < len(token) else None

        while heap:
            rank, i = heapq.heappop(heap)
            if token[i] < 0 or pair(i) != rank:
                continue
            j = after[i]
            token[i], token[j], after[i] = rank, -1, after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (found := pair(k)) is not None:
                    heapq.heappush(heap, (found, k))
        return np.array([t for t in token if t >= 0], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(sizes == 0):
            out[i] = np.zeros(0, np.int64)
        for low, width in zip((0, *BUCKETS), BUCKETS):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            step = max(1, CELLS // width)
            for at in range(0, len(rows), step):
                block = rows[at : at + step]
                for i, ids in zip(block, self._matrix([pieces[i] for i in block], width)):
                    out[i] = ids
        for i in np.flatnonzero(sizes > BUCKETS[-1]):
            out[i] = self._heap(pieces[i])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts."""
        if len(self.kept) > KEPT_PIECES or self.kept_bytes > KEPT_BYTES:
            self.forget()
        number = self.kept.__getitem__
        cut = [np.array(list(map(number, self.split(text))), np.int32) for text in texts]
        new = [p.encode("utf-8", "surrogatepass") for p in self.kept.new]
        self.kept.new.clear()
        self.kept_ids.extend([x.astype(np.int32) for x in self.encode_pieces(new)])
        self.kept_bytes += sum(map(len, new))
        return [self.kept_ids.gather(numbers) for numbers in cut]

    def printed(self, ids: np.ndarray) -> bytes:
        """The ids as decimals joined by commas."""
        return self.decimals.gather(ids).tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.tokens.gather(ids).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process; the file is one of the installed tokenizer package."""
    return ByteBpe(read_ranks(path), pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>, n_tokens, ids_sha256, decoded_sha256) of every row.

    A null text counts as empty: no ids, the digests of the empty string. Rows that repeat are
    returned as often as they occur; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    names = ["id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                columns: list[list] = [[], [], [], []]
                for ids in bpe.encode(batch.column(1).to_pylist()):
                    digests = (hashlib.sha256(f(ids)).hexdigest() for f in (bpe.printed, bpe.decode))
                    done = (ids, len(ids), *digests)
                    for column, x in zip(columns, done):
                        column.append(x)
                types = (pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    schema = f"id {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
