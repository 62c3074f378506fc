"""Removal of long repeated byte strings with per-shard suffix arrays.

1. Anchors. Every ``size``-byte window takes as its key the least hash of the ``anchor``-byte strings
   inside it (a sliding minimum in numpy). Equal windows have equal keys wherever they stand, and
   neighbouring windows mostly share one, so a text becomes a few runs (key, first, last window).
   Keys that occur once cannot belong to a repeated window and are dropped by a count.
2. Stretches. For each remaining run the text its windows cover is cut out. Equal stretches of a key
   are combined, with their number, before they are shuffled.
3. Shards. Stretches are dealt by key, so equal windows meet. A shard is sorted by Larsson-Sadakane
   refinement (``suffix_array``), its common prefixes follow by Kasai's bound (``common_prefixes``),
   and a window is repeated if a neighbour in suffix order shares ``size`` bytes, or if its stretch
   occurs more than once.
4. Hot keys, with more than ``most`` different stretches or ``KEY_BYTES`` of them (long periodic
   texts have few, but long ones), are dealt to several shards. In each, equal
   neighbours of the suffix order become one window; the distinct windows are cut at common borders of
   their hashes, and the slices of one range from all shards are merged in one task, which receives a
   window at most once per shard. The repeated ones return to their shards and mark the stretches.
5. Repeated windows return to their documents as byte ranges.

Only lists of one document or one shard are held in a task; nothing is collected but sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of

BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SHARD_BYTES = 1 << 20
#: Bytes of one key's stretches in a shard; a suffix array takes some 80 times as much.
KEY_BYTES = 6 << 20


# -- anchors ----------------------------------------------------------------------------------
def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``width``-byte string, from prefix sums modulo 2^64."""
    n = len(data)
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"] = _powers(BASE, max(n, 1 << 16))
        _TABLES["down"] = _powers(INVERSE, max(n, 1 << 16))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _TABLES["up"][:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * _TABLES["down"][: n - width + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The least or largest of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def _twice(
    hashes: np.ndarray, least: np.ndarray, first: np.ndarray, last: np.ndarray, wide: int
) -> np.ndarray:
    """1 for each run in which its least hash stands at two places, else 0.

    A place is the least of some window if it equals the largest least of the windows around it.
    These few places, sorted by hash and position, are counted for each run by binary search.
    """
    around = np.pad(least, wide - 1)
    places = np.flatnonzero(_sliding(np.maximum, around, wide) == hashes)
    values, number = np.unique(hashes[places], return_inverse=True)
    step = len(hashes) + 1
    listed = np.sort(number * step + places)
    of_run = np.searchsorted(values, least[first]) * step
    ends = np.searchsorted(listed, of_run + last + wide)
    return (ends - np.searchsorted(listed, of_run + first) > 1).astype(np.int64)


def runs_of(data: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first window, last window) of a text, in bounded blocks.

    A run inside which the least hash stands twice, as in periodic text, is listed twice: windows
    of it may equal one another.
    """
    keys, firsts, lasts = [], [], []
    wide = size - anchor + 1
    for at in range(0, len(data) - size + 1, BLOCK):
        block = data[at : at + BLOCK + size - 1]
        hashes = _hashes(block, anchor)
        least = _sliding(np.minimum, hashes, wide)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(first[1:], len(least)) - 1
        key = least[first]
        again = 1 + _twice(hashes, least, first, last, wide)
        keys.append(np.repeat(key, again).view(np.int64))
        firsts.append(np.repeat(first, again) + at)
        lasts.append(np.repeat(last, again) + at)
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (keys, firsts, lasts))


# -- suffix arrays ----------------------------------------------------------------------------
def _first_words(text: np.ndarray) -> np.ndarray:
    """The next 8 bytes of every position as a big-endian number; ``text`` ends in 8 zeros."""
    n = len(text) - 8
    words = np.zeros(n, np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | text[j : j + n]
    return words


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes.

    Larsson-Sadakane refinement: sorted by 8 bytes first; then each group of equals is sorted by
    the group of the position ``reach`` bytes further on, which doubles the sorted prefix. Groups
    of one are final and are not touched again. A suffix that ends sorts before a longer one.
    """
    n = len(words)
    order = np.argsort(words)
    new = np.ones(n, bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n, np.int64)
    rank[order] = group
    reach = 8
    while True:
        slots = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(slots):
            return order
        positions, head = order[slots], group[slots]
        further = positions + reach
        ahead = np.where(further < n, rank[np.minimum(further, n - 1)], n - 1 - further)
        by = np.argsort(head * (3 * n + reach) + ahead + n + reach)
        positions, ahead, head = positions[by], ahead[by], head[by]
        order[slots] = positions
        step = np.ones(len(slots), bool)
        step[1:] = (head[1:] != head[:-1]) | (ahead[1:] != ahead[:-1])
        new[slots] = step
        group[slots] = slots[np.maximum.accumulate(np.where(step, np.arange(len(slots)), 0))]
        rank[positions] = group[slots]
        reach *= 2


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, at most ``depth``.

    Kasai's bound, a suffix shares at least one byte less than the suffix one position earlier, is
    used in strides: every 256th position first, then those between them, which start where the
    bound from the left puts them and compare 8 bytes at a time.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    stride, known = 256, 0
    while stride:
        at = np.arange(0, n, stride) if not known else np.arange(stride, n, known)
        other = before[at]
        at, other = at[other >= 0], other[other >= 0]
        start = shared[np.maximum(at - stride, 0)] - stride if known else np.zeros(len(at), np.int64)
        reached = np.maximum(start, 0)
        live = np.arange(len(at))
        while len(live):
            i, j = at[live] + reached[live], other[live] + reached[live]
            inside = (i < n) & (j < n) & (reached[live] < depth)
            live, i, j = live[inside], i[inside], j[inside]
            differ = words[i] ^ words[j]
            same = differ == 0
            part = differ[~same]
            equal = np.zeros(len(part), np.int64)
            for byte in range(7):
                equal += (part >> np.uint64(56 - 8 * byte)) == 0
            reached[live[~same]] += equal
            live = live[same]
            reached[live] += 8
        # Beyond the end of the text both sides are zeros; a suffix never shares more than it has.
        shared[at] = np.minimum(np.minimum(reached, depth), n - np.maximum(at, other))
        known, stride = stride, stride // 2
    return shared[order]


def sorted_windows(parts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the parts in suffix order: (part, offset, equal to the window before it)."""
    text = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    words = _first_words(text)
    order = suffix_array(words)
    shared = common_prefixes(words, order, size)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths) - lengths
    part = np.repeat(np.arange(len(parts)), lengths)
    offset = np.arange(len(words)) - starts[part]
    whole = np.flatnonzero((offset <= lengths[part] - size)[order])
    if not len(whole):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(bool)
    # Between two windows stand suffixes that are cut short: the least common prefix counts.
    least = np.minimum.reduceat(shared, np.concatenate(([0], whole[:-1] + 1)))[: len(whole)]
    least[0] = 0
    chosen = order[whole]
    return part[chosen], offset[chosen], least >= size


def repeated_windows(equal: np.ndarray) -> np.ndarray:
    return equal | np.append(equal[1:], False)


def _ranges(marks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges [first, last) covered by marked windows."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return edges[::2], edges[1::2] - 1 + size


# -- the job ----------------------------------------------------------------------------------
def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text): a document is known by its id and a hash of its text; nulls count as empty."""
    text = text_of(text_col)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h")).alias("doc")
    return docs.select(doc, text.alias("text"))


def _runs(keyed: DataFrame, size: int, anchor: int) -> DataFrame:
    """(doc, key, first, last) arrays of every document with at least one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, found = [], []
                for i, text in enumerate(batch.column(1)):
                    data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                    if len(data) >= size:
                        rows.append(i)
                        found.append(runs_of(data, size, anchor))
                lists = [pa.array([f[c] for f in found], pa.list_(pa.int64())) for c in range(3)]
                doc = batch.column(0).take(pa.array(rows, pa.int32()))
                yield pa.RecordBatch.from_arrays([doc, *lists], names=["doc", "key", "first", "last"])

    kind = keyed.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, key array<long>, first array<long>, last array<long>"
    small = keyed.where(F.octet_length("text") >= size)
    found = staged(small.mapInArrow(run, schema), "runs")
    zipped = F.explode(F.arrays_zip("key", "first", "last")).alias("r")
    return found.select("doc", zipped).select("doc", "r.*")


def _cut(held: DataFrame, size: int, with_text: bool) -> DataFrame:
    """One row per candidate run: key, digest and either the stretch or its place."""
    kind = held.schema["doc"].dataType.simpleString()
    schema = "key long, digest binary, " + (
        "stretch binary" if with_text else f"doc {kind}, first long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                rows: list[int] = []
                columns: list[list] = [[], [], []]
                for i, (text, places) in enumerate(zip(batch.column(1), batch.column(2))):
                    data = text.as_buffer().to_pybytes()
                    for r in places.as_py():
                        stretch = data[r["first"] : r["last"] + size]
                        rows.append(i)
                        columns[0].append(r["key"])
                        columns[1].append(hashlib.blake2b(stretch, digest_size=16).digest())
                        columns[2].append(stretch if with_text else r["first"])
                key = pa.array(columns[0], pa.int64())
                digest = pa.array(columns[1], pa.binary())
                if with_text:
                    more = {"stretch": pa.array(columns[2], pa.binary())}
                else:
                    doc = batch.column(0).take(pa.array(rows, pa.int32()))
                    more = {"doc": doc, "first": pa.array(columns[2], pa.int64())}
                yield pa.RecordBatch.from_pydict({"key": key, "digest": digest, **more})

    return held.select("doc", "text", "places").mapInArrow(run, schema)


FOUND = "key long, digest binary, begins array<long>, ends array<long>"


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    key, digest, begins, ends = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key, pa.int64()),
            pa.array(digest, pa.binary()),
            pa.array(begins, pa.list_(pa.int64())),
            pa.array(ends, pa.list_(pa.int64())),
        ],
        names=["key", "digest", "begins", "ends"],
    )


def _by_part(part: np.ndarray, offset: np.ndarray, lengths: list[int], size: int) -> Iterator[tuple]:
    """(part, begins, ends) of the marked windows, part by part."""
    by = np.argsort(part, kind="stable")
    part, offset = part[by], offset[by]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for offsets, p in zip(np.split(offset, cuts), part[np.concatenate(([0], cuts))] if len(part) else ()):
        marks = np.zeros(lengths[p] - size + 1, bool)
        marks[offsets] = True
        yield int(p), *_ranges(marks, size)


def _in_shards(stretches: DataFrame, size: int) -> DataFrame:
    """Repeated ranges of the stretches of each key; rows come sorted by key."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts = [r[2] for r in rows]
        part, offset, equal = sorted_windows(parts, size)
        several = np.array([r[3] > 1 for r in rows])
        marked = repeated_windows(equal) | several[part]
        lengths = list(map(len, parts))
        out = [
            (rows[p][0], rows[p][1], begins, ends)
            for p, begins, ends in _by_part(part[marked], offset[marked], lengths, size)
        ]
        if out:
            yield _found_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held >= SHARD_BYTES and row[0] != rows[-1][0]:
                    yield from solve(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[2])
        if rows:
            yield from solve(rows)

    return stretches.select("key", "digest", "stretch", "n").mapInArrow(run, FOUND)


def _window_digests(stretch: bytes, size: int) -> np.ndarray:
    """Two independent 64-bit hashes of every window."""
    data = np.frombuffer(stretch, np.uint8)
    turned = np.ascontiguousarray((data ^ 0xA5) * np.uint8(167))
    return np.stack((_hashes(data, size), _hashes(turned, size) * BASE), axis=1)


def _shard_windows(cut: DataFrame, size: int) -> DataFrame:
    """Distinct windows of every shard of hot keys, by hash range, and whether they repeat in it.

    Equal windows are neighbours in suffix order and become one entry, in however many stretches
    they stand, so a range receives a window at most once per shard.
    """
    slices = "key long, range long, shard long, high array<long>, low array<long>, many array<boolean>"

    def sort_shard(frame: pd.DataFrame) -> pd.DataFrame:
        parts = frame["stretch"].tolist()
        part, offset, equal = sorted_windows(parts, size)
        starts = np.concatenate(([0], np.cumsum([len(p) - size + 1 for p in parts])))[:-1]
        digests = np.concatenate([_window_digests(p, size) for p in parts])
        first = np.flatnonzero(~equal)
        several = (frame["n"] > 1).to_numpy()
        many = np.logical_or.reduceat(several[part], first) | (np.diff(first, append=len(part)) > 1)
        chosen = digests[starts[part[first]] + offset[first]]
        by = np.argsort(chosen[:, 0], kind="stable")
        chosen, many = chosen[by], many[by]
        count = int(frame["ranges"].iloc[0])
        borders = [np.uint64((i << 64) // count) for i in range(1, count)]
        cuts = [0, *np.searchsorted(chosen[:, 0], borders).tolist(), len(chosen)]
        key, shard = int(frame["key"].iloc[0]), int(frame["shard"].iloc[0])
        rows = [
            (key, number, shard, chosen[i:j, 0].view(np.int64), chosen[i:j, 1].view(np.int64), many[i:j])
            for number, (i, j) in enumerate(zip(cuts, cuts[1:]))
            if i < j
        ]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in slices.split(", ")])

    return cut.groupBy("key", "shard").applyInPandas(sort_shard, slices)


def _same_windows(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal windows are neighbours, and where in it a new window begins."""
    by = np.lexsort((low, high))
    new = np.ones(len(by), bool)
    new[1:] = (high[by[1:]] != high[by[:-1]]) | (low[by[1:]] != low[by[:-1]])
    return by, np.flatnonzero(new)


def _hot(stretches: DataFrame, size: int, most: int, key_bytes: int) -> DataFrame:
    """Repeated ranges of keys with too many stretches for one shard, or too long ones."""
    count = F.ceil(F.greatest(F.col("different") / most, F.col("n_bytes") / key_bytes))
    cut = stretches.select(
        "key", F.pmod(F.xxhash64("digest"), count).alias("shard"), "digest", "stretch", "n",
        count.alias("ranges"),
    )
    repeated = "key long, shard long, high array<long>, low array<long>"

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        """Windows of one range that occur more than once, for each shard that has them."""
        high, low, many = (np.concatenate(frame[c].tolist()) for c in ("high", "low", "many"))
        shard = np.repeat(frame["shard"].to_numpy(), [len(h) for h in frame["high"]])
        by, first = _same_windows(high, low)
        sizes = np.diff(first, append=len(by))
        marked = np.logical_or.reduceat(many[by].astype(bool), first) | (sizes > 1)
        found = by[np.repeat(marked, sizes)]
        found = found[np.argsort(shard[found], kind="stable")]
        key = int(frame["key"].iloc[0])
        rows = [
            (key, int(shard[f[0]]), high[f], low[f])
            for f in np.split(found, np.flatnonzero(np.diff(shard[found])) + 1)
            if len(f)
        ]
        return pd.DataFrame(rows, columns=["key", "shard", "high", "low"])

    def mark(frame: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        """The ranges of a shard's stretches that its listed windows cover."""
        if listed.empty:
            return pd.DataFrame([], columns=["key", "digest", "begins", "ends"])
        parts = frame["stretch"].tolist()
        lengths = list(map(len, parts))
        windows = np.array(lengths) - size + 1
        digests = np.concatenate([_window_digests(p, size) for p in parts]).view(np.int64)
        high, low = (
            np.concatenate([digests[:, c], *listed[name]]) for c, name in ((0, "high"), (1, "low"))
        )
        by, first = _same_windows(high, low)
        hit = np.logical_or.reduceat(by >= len(digests), first)
        inside = by[np.repeat(hit, np.diff(first, append=len(by)))]
        inside = np.sort(inside[inside < len(digests)])
        part = np.repeat(np.arange(len(parts)), windows)[inside]
        offset = inside - (np.cumsum(windows) - windows)[part]
        key, names = int(frame["key"].iloc[0]), frame["digest"].tolist()
        rows = [(key, names[p], i, j) for p, i, j in _by_part(part, offset, lengths, size)]
        return pd.DataFrame(rows, columns=["key", "digest", "begins", "ends"])

    merged = _shard_windows(cut, size).groupBy("key", "range").applyInPandas(merge, repeated)
    back = merged.groupBy("key", "shard")
    return cut.groupBy("key", "shard").cogroup(back).applyInPandas(mark, FOUND)


def _keep_short(data: bytes, gone: np.ndarray, least_words: int) -> None:
    """Take back the marks of runs with fewer words."""
    for begin, end in zip(*_ranges(gone, 1)):
        if len(data[begin:end].split()) < least_words:
            gone[begin:end] = False


def _cleaned(held: DataFrame, places: DataFrame, with_text: bool, least_words: int) -> DataFrame:
    """(doc, n_removed, n_spans, kept_sha256, kept_text) of documents with repeated ranges.

    Ranges that, taken together where they touch, hold fewer than ``least_words`` words stay.
    """
    ranges = places.groupBy("doc").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    rows = held.select("doc", "text").join(ranges, "doc")
    kind = held.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                columns: list[list] = [[], [], [], []]
                for text, ranges in zip(batch.column(1), batch.column(2)):
                    data = text.as_buffer().to_pybytes()
                    edges = np.zeros(len(data) + 1, np.int64)
                    both = np.array([(r["begin"], r["end"]) for r in ranges.as_py()], np.int64)
                    np.add.at(edges, both[:, 0], 1)
                    np.add.at(edges, both[:, 1], -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    if least_words:
                        _keep_short(data, gone, least_words)
                    columns[0].append(int(gone.sum()))
                    columns[1].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    columns[2].append(hashlib.sha256(kept).hexdigest())
                    columns[3].append(kept.decode("utf-8", "ignore") if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.string()),
                        pa.array(columns[3], pa.string()),
                    ],
                    names=["doc", "n_removed", "n_spans", "kept_sha256", "kept_text"],
                )

    schema = f"doc {kind}, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return rows.select("doc", "text", "ranges").mapInArrow(run, schema).dropDuplicates(["doc"])


def changed(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    size: int,
    anchor: int,
    most: int,
    with_text: bool,
    least_words: int = 0,
    key_bytes: int = KEY_BYTES,
) -> DataFrame:
    """(doc, n_removed, n_spans, kept_sha256, kept_text) of the documents that lose something."""
    keyed = _keyed(docs, id_col, text_col)
    runs = _runs(keyed, size, anchor)
    twice = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    # Written first: a join with an aggregate that shares its shuffle never splits a hot key.
    twice = staged(twice, "twice")
    places = (
        runs.join(twice, "key", "left_semi")
        .groupBy("doc")
        .agg(F.collect_set(F.struct("key", "first", "last")).alias("places"))
    )
    held = staged(keyed.join(places, "doc"), "held")
    distinct = (
        _cut(held, size, True)
        .groupBy("key", "digest", "stretch")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    distinct = staged(distinct, "stretches")
    sizes = distinct.groupBy("key").agg(
        F.count(F.lit(1)).alias("different"),
        F.sum(F.octet_length("stretch").cast("long")).alias("n_bytes"),
    )
    # One stretch alone has nothing to be compared with elsewhere and stays in one piece.
    large = (F.col("different") > most) | ((F.col("n_bytes") > key_bytes) & (F.col("different") > 1))
    hot_keys = staged(sizes.where(large), "hot")
    cold = distinct
    found = []
    if hot_keys.head(1):
        cold = distinct.join(hot_keys, "key", "left_anti")
        found.append(_hot(distinct.join(hot_keys, "key"), size, most, key_bytes))
    dealt = cold.repartition("key").sortWithinPartitions("key")
    found.append(_in_shards(dealt, size))
    ranges = found[0] if len(found) == 1 else found[0].union(found[1])
    zipped = F.explode(F.arrays_zip("begins", "ends")).alias("r")
    ranges = staged(ranges.select("key", "digest", zipped).select("key", "digest", "r.*"), "ranges")
    back = _cut(held, size, False).join(ranges, ["key", "digest"])
    back = back.select(
        "doc",
        (F.col("first") + F.col("begins")).alias("begin"),
        (F.col("first") + F.col("ends")).alias("end"),
    )
    return _cleaned(held, back, with_text, least_words)


def repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 400,
    anchor: int = 200,
    most: int = 8192,
    key_bytes: int = KEY_BYTES,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a ``size``-byte string that covers it also starts anywhere else in the
    input, the same document included. A null text counts as empty; texts shorter than ``size`` stay
    whole; rows that repeat are documents of their own and so lose every window. Other columns are
    ignored.
    """
    lost = changed(docs, id_col, text_col, size, anchor, most, False, 0, key_bytes).select(
        "doc", "n_removed", "n_spans", "kept_sha256"
    )
    text = F.col("text")
    small = _keyed(docs, id_col, text_col).select(
        "doc", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha")
    )
    none = F.lit(0).cast("long")
    return small.join(lost, "doc", "left").select(
        F.col("doc.id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    size: int = 400,
    anchor: int = 200,
    most: int = 8192,
    least_words: int = 0,
) -> DataFrame:
    """``docs`` with repeated bytes taken out of the text, and its length in ``chars_col`` renewed.

    A repeated passage is taken out if it has at least ``size`` bytes and ``least_words`` words. A
    character of which a removed range took some bytes only goes altogether. Documents without
    any text left are dropped if they had some; null texts stay null. Other columns may have any
    names and types.
    """
    names = docs.columns
    lost = changed(docs, id_col, text_col, size, anchor, most, True, least_words)
    lost = lost.where("n_removed > 0").select("doc", "kept_text")
    text = text_of(text_col)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h")).alias("doc")
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    joined = docs.select(doc, row).join(lost, "doc", "left")
    joined = joined.where("kept_text IS NULL OR kept_text <> ''")
    kept, was = F.col("kept_text"), {c: F.col("row").getField(c) for c in names}
    now = dict(was)
    now[text_col] = F.coalesce(kept, was[text_col])
    if chars_col in names:
        renewed = F.when(kept.isNull(), was[chars_col]).otherwise(F.length(kept))
        now[chars_col] = renewed.cast(docs.schema[chars_col].dataType)
    return joined.select(*(c.alias(name) for name, c in now.items()))
