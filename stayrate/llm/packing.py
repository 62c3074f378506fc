"""Packing token pieces into fixed-length sequences by cutting-stock column generation.

1. Every document is tokenized once; it is cut after each full sequence length, so that only its
   last piece is shorter. One row per piece is written to the shared folder.
2. Pieces are counted by length class (lengths rounded up to ``unit`` tokens). Only this histogram,
   at most ``size / unit`` rows, comes to the driver.
3. A linear program chooses how often each pattern (a multiset of classes that fits a sequence) is
   used. Its columns are generated: a knapsack over the dual prices finds the best new pattern.
   Fractions are rounded down; what is left over is packed first-fit decreasing.
4. Pieces are ranked inside their class by bucket counts, without a window over a whole class, and
   the rank says which copy of which pattern a piece belongs to.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayrate.llm.common import staged, text_of
from stayrate.llm.flat import Numbers, Strings

KEPT_WORDS, ROWS = 400_000, 1024
ROWS_PER_BUCKET = 50_000
PIECES = "id {}, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


# -- tokens -----------------------------------------------------------------------------------
class WordTokens:
    """Ids of whole texts, a word at a time.

    The tokenizer drops white space and never looks past it, so the ids of a text are those of its
    words, one after another. Arrow splits the texts of a batch and numbers their distinct words;
    only words not seen before are tokenized. Words of Latin letters, digits and ASCII signs are cut
    into the tokenizer's own units here and go straight to its model; all others take its full path.
    That holds for files with the normaliser and pre-tokenizer of ``BY_WORDS``; by any other file
    whole texts take the full path.
    """

    BY_WORDS = {
        "normalizer": {"type": "Sequence", "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split",
             "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
             "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    }

    UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall
    NOT_PLAIN = re.compile("[^!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]").search

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        # Added tokens that are not special are found in the text before it is cut into words.
        special = all(token["special"] for token in parts["added_tokens"])
        self.by_words = special and all(parts[name] == part for name, part in self.BY_WORDS.items())
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = filter(str.isprintable, map(chr, range(0x21, 0x250)))
        self.spelled = str.maketrans({c: as_bytes.pre_tokenize_str(c)[0][0] for c in latin})
        self.forget()

    def forget(self) -> None:
        self.known, self.ids = Numbers(), Strings([], np.int32)
        self.units: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        found = self.tokenizer.model.tokenize(unit.translate(self.spelled))
        self.units[unit] = ids = array("i", [t.id for t in found]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if self.NOT_PLAIN(word):
            found = self.tokenizer.encode(word, add_special_tokens=False)
            return array("i", found.ids).tobytes()
        known = self.units
        return b"".join([known.get(u) or self._unit(u) for u in self.UNITS(word.lower())])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        if not self.by_words:
            found = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            return [np.array(e.ids, np.int32) for e in found]
        if len(self.known) > KEPT_WORDS:
            self.forget()
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        words = pc.split_pattern(texts.cast(pa.large_string()), " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.array(list(map(self.known.__getitem__, distinct)), np.int64)
        new, self.known.new = self.known.new, []
        ids = [self._word(word) for word in new]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.ids.append(np.frombuffer(b"".join(ids), np.int32), counts)
        flat = numbers[coded.indices.to_numpy()] if distinct else numbers
        ends = words.offsets.to_numpy()
        return [self.ids.gather(flat[i:j]) for i, j in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def pieces(
    docs: DataFrame, path: str, size: int, end_id: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """One row per piece of every document: id, start, length, ids_crc32, doc_tokens, ids."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                out: list[tuple] = []
                for row, ids in enumerate(tokens.encode(batch.column(1))):
                    ids = np.append(ids, np.int32(end_id)).astype("<i4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        crc = zlib.crc32(piece.tobytes())
                        kept = piece if with_ids else None
                        out.append((row, start, len(piece), crc, len(ids), kept))
                row, *columns = zip(*out)
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
                arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
                first = batch.column(0).take(pa.array(row, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [first, *arrays],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    return rows.mapInArrow(run, PIECES.format(kind))


# -- patterns ---------------------------------------------------------------------------------
def best_pattern(prices: np.ndarray, weights: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of highest price that fits, by dynamic programming."""
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for w in range(1, room + 1):
        fits = int(np.searchsorted(weights, w, side="right"))
        value[w], choice[w] = value[w - 1], -1
        if fits:
            sums = value[w - weights[:fits]] + prices[:fits]
            best = int(sums.argmax())
            if sums[best] > value[w] + 1e-12:
                value[w], choice[w] = sums[best], best
    pattern, w = np.zeros(len(weights)), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= int(weights[choice[w]])
    return float(value[room]), pattern


def relaxed(weights: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, by revised simplex with column generation."""
    size = len(weights)
    columns = np.diag((room // weights).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    for step in range(20 * size):
        prices = inverse.sum(axis=0)  # every pattern costs one sequence
        value, pattern = best_pattern(np.maximum(prices, 0), weights, room)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ pattern
        rising = direction > 1e-9
        ratios = np.where(rising, used / np.where(rising, direction, 1), np.inf)
        out = int(ratios.argmin())
        columns[:, out] = pattern
        if step % 200 == 199:  # against drift
            inverse = np.linalg.inv(columns)
        else:
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
        used = np.maximum(inverse @ demand, 0)
    return columns, used


def patterns(counts: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """[(class -> pieces per sequence, number of sequences)] that take up all counted pieces."""
    if not counts:
        return []
    weights = np.array(sorted(counts))
    demand = np.array([counts[w] for w in weights], np.int64)
    columns, used = relaxed(weights, demand.astype(float), room)
    rest, found = demand.copy(), []
    for column, times in zip(columns.T.astype(np.int64), used):
        some = column > 0
        times = int(min(np.floor(times + 1e-6), (rest[some] // column[some]).min()))
        if times > 0:
            rest -= times * column
            found.append(({int(w): int(n) for w, n in zip(weights, column) if n}, times))
    left = {int(w): int(n) for w, n in zip(weights, rest) if n}
    while left:
        free, pattern = room, {}
        for w in sorted(left, reverse=True):
            if n := min(free // w, left[w]):
                pattern[w] = n
                free -= n * w
        times = min(left[w] // n for w, n in pattern.items())
        found.append((pattern, times))
        for w, n in pattern.items():
            left[w] -= n * times
            if not left[w]:
                del left[w]
    return found


def intervals(found: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (class, first rank, pieces per sequence, first sequence) in order of class and rank."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in found:
        for w, n in pattern.items():
            rows.append((w, rank.get(w, 0), n, sequence))
            rank[w] = rank.get(w, 0) + n * times
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


# -- assignment -------------------------------------------------------------------------------
def _ranked(rows: DataFrame) -> DataFrame:
    """A dense ``rank`` from 0 in each class: bucket totals added up, numbers inside buckets."""
    buckets = rows.count() // ROWS_PER_BUCKET + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("class", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("class", "bucket").orderBy("id", "start", "ids_crc32")
    numbered = rows.withColumn("number", F.row_number().over(inside) - 1)
    ranked = numbered.join(offsets, ["class", "bucket"])
    return ranked.withColumn("rank", F.col("first") + F.col("number"))


def _placed(ranked: DataFrame, table: np.ndarray) -> DataFrame:
    """``sequence_id`` of every ranked piece; ``table`` has a row per class and pattern."""
    shift = 1 << 40
    keys = table[:, 0] * shift + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = (batch.column(n).to_numpy() for n in ("class", "rank"))
            at = np.searchsorted(keys, kind * shift + rank, side="right") - 1
            sequence = table[at, 3] + (rank - table[at, 1]) // table[at, 2]
            arrays = [*batch.columns, pa.array(sequence, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "sequence_id"])

    kept = ["id", "start", "length", "ids_crc32", "doc_tokens", "ids", "class", "rank", "piece"]
    names = ranked.select(*(c for c in kept if c in ranked.columns))
    schema = ", ".join(f"{n} {t}" for n, t in names.dtypes) + ", sequence_id long"
    return names.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    path: str,
    size: int = 4096,
    end_id: int = 2,
    unit: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A null or empty text has one piece, its end id. Rows that repeat are packed as often as they
    occur; other columns are ignored; no rows give no sequences. A sequence never exceeds ``size``.
    Pieces are ranked and placed without their ids, which join their places once at the end.
    """
    cut = pieces(docs, path, size, end_id, id_col, text_col, with_ids)
    if with_ids:
        cut = cut.withColumn("piece", F.monotonically_increasing_id())
    cut = staged(cut, "pieces")
    light = cut.withColumn("ids", F.lit(None).cast("array<int>")) if with_ids else cut
    classed = light.withColumn("class", F.ceil(F.col("length") / unit))
    histogram = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}
    table = intervals(patterns(histogram, size // unit))
    placed = _placed(_ranked(classed), table)
    order = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    if not with_ids:
        return placed.select(F.col("id").alias(id_col), *names, offset)
    found = placed.select("piece", F.col("id").alias(id_col), *names, offset.alias("offset"))
    whole = found.join(cut.select("piece", "ids"), "piece")
    return whole.select(id_col, *names, "offset", "ids")
