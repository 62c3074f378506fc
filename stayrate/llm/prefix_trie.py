"""Prefix trie of conversations: Z-fast tries per task, merged by the digests of their prefixes.

A conversation is a sequence of turns, and every prefix of it has a 128-bit digest: the sum of the
hashes of (depth, turn). Sums can be continued, so a long conversation is cut into bands of ``BAND``
turns that lie in different tasks and still know the digests of their whole prefixes.

``ZFastTrie`` keeps compacted nodes only. A node stands in a hash table under its *handle*, the
prefix at the two-fattest depth of its edge (the depth that is divisible by the largest power of
two). Where a sequence leaves the trie is found by fat binary search: log2(length) look-ups of
prefix digests instead of a walk along its turns. Sequences come in batches, one trie per task, and
a trie of more than ``MOST`` depths is expanded and started anew, so memory is bounded.

1. Every task inserts its bands and expands the edges of its trie into one row per depth. Merged by
   digest these rows give each node its members and its smallest member, which owns the node. A
   conversation owns the nodes below the depth at which it leaves the trie of the smaller ones.
2. Every conversation is inserted again, only down to that depth, with what it adds to the nodes
   above: its shared bytes, whether it ends in a leaf, a child. Expanded and merged these are the
   subtree sums; the nodes a conversation owns are read off its own path.

Nodes that very many conversations share are one row per task before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of

#: Turns of one conversation that travel in one row.
BAND = 256
#: Depths and nodes a task's trie may hold before it is written out.
MOST = 1 << 18
#: Ids of one text chunk on the way to a digest of all ids.
CHUNK = 4096
LANES = 4
MASK = 0xFFFFFFFF
WIDTH = 16
ROOT = bytes(WIDTH)


# -- order and digests of turns ----------------------------------------------------------------
def slices(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(id, place 1 … n, turn_hash, n_bytes) of every turn; texts do not leave the first task.

    Turns are ordered by number, nulls first, ties by the MD5 of role and text. Rows without an id
    belong to no conversation. The order is cut into ranges of equal size and the rows before a
    range are added up per conversation, so no conversation has to fit into one task.
    """
    role, text = text_of(role_col), text_of(text_col)
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    known = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.md5(said)).alias("turn_hash"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = ("turn", "turn_hash")
    cut = known.repartitionByRange(slices(rows), "id", *order)
    cut = staged(cut.withColumn("slice", F.spark_partition_id()), "turns")
    earlier = Window.partitionBy("id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("id", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    inside = F.row_number().over(Window.partitionBy("id", "slice").orderBy(*order))
    placed = cut.join(before, ["id", "slice"])
    return staged(placed.select("id", (F.col("n") + inside).alias("place"), "turn_hash", "n_bytes"), "places")


def rebranched(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first turns of its family's first one in place of its own.

    Conversation c takes h = crc32(decimal c) % ``heads`` turns of conversation c - c % ``family``
    (fewer if that has fewer, none if it is absent), then its own after the first h; % is never
    negative, so families of negative ids are as large. Returns the turns (id, depth, turn_hash,
    n_bytes) and the conversations (id, n), also those left without turns.
    """
    own = turns.groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    h = F.crc32(F.col("id").cast("string").cast("binary")) % heads
    convs = own.select("id", "own", h.alias("h"), (F.col("id") - F.pmod("id", F.lit(family))).alias("base"))
    bases = own.select(F.col("id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").select(
        "id", "own", "h", "base", F.least("h", F.coalesce("base_own", F.lit(0))).alias("taken")
    )
    first = turns.where(F.col("place") < heads).withColumnRenamed("id", "base")
    taken = convs.select("id", "h", "base").join(first, "base").where("place <= h")
    taken = taken.select("id", F.col("place").alias("depth"), "turn_hash", "n_bytes")
    # h follows from the id; only where the family's first conversation is shorter is there a shift.
    shift = convs.where("taken < h").select("id", (F.col("h") - F.col("taken")).alias("short"))
    rest = turns.withColumn("h", h).where("place > h").join(shift, "id", "left")
    depth = (F.col("place") - F.coalesce("short", F.lit(0))).alias("depth")
    kept = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return (
        rest.select("id", depth, "turn_hash", "n_bytes").unionByName(taken),
        convs.select("id", (F.col("taken") + kept).alias("n")),
    )


def _lanes() -> list[Column]:
    """Four 32-bit hashes of a turn at its depth; their sums along a path are its digest."""
    first = F.xxhash64("depth", "turn_hash")
    second = F.xxhash64("turn_hash", F.lit("second"), "depth")
    return [x for h in (first, second) for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(MASK)))]


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and band: id, n, band, lanes and bytes before it, its turns, and
    the digest of the whole conversation in its last band. Conversations without turns have band 0."""
    lanes = [f"l{i}" for i in range(LANES)]
    band = F.call_function("div", F.col("depth") - 1, F.lit(BAND)).alias("band")
    hashed = turns.select("id", "depth", "n_bytes", band, *(x.alias(n) for x, n in zip(_lanes(), lanes)))
    banded = hashed.groupBy("id", "band").agg(
        *(F.sum(n).alias(n) for n in (*lanes, "n_bytes")),
        F.sort_array(F.collect_list(F.struct("depth", *lanes, "n_bytes"))).alias("turns"),
    )
    banded = staged(banded, "bands")
    earlier = Window.partitionBy("id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = (*lanes, "n_bytes")
    every = Window.partitionBy("id")
    before = banded.select(
        "id",
        "band",
        F.sum("n_bytes").over(every).alias("total_bytes"),
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in sums),
        *(F.col(n).alias(f"{n}_here") for n in lanes),
    )
    zero = F.lit(0).cast("long")
    info = convs.join(before, "id", "left").select(
        "id",
        "n",
        F.coalesce("band", zero).alias("band"),
        F.coalesce("total_bytes", zero).alias("total_bytes"),
        *(F.coalesce(f"{n}_before", zero).alias(f"{n}_before") for n in sums),
        F.unhex(F.concat(*(
            F.lpad(F.hex((F.coalesce(f"{n}_before", zero) + F.coalesce(f"{n}_here", zero)).bitwiseAND(F.lit(MASK))), 8, "0")
            for n in lanes
        ))).alias("whole"),
    )
    last = F.col("n") <= (F.col("band") + 1) * BAND
    return info.join(banded.select("id", "band", "turns"), ["id", "band"], "left").select(
        "id",
        "n",
        "band",
        F.array(*(F.col(f"{n}_before") for n in sums)).alias("before"),
        F.when(last, F.col("whole")).alias("whole"),
        "total_bytes",
        "turns",
    )


# -- the trie ----------------------------------------------------------------------------------
class Path:
    """The digests of the prefixes of depth ``low`` … ``high``, and the bytes up to each."""

    __slots__ = ("low", "high", "digests", "n_bytes")

    def __init__(self, low: int, high: int, digests: bytes, n_bytes: np.ndarray):
        self.low, self.high, self.digests, self.n_bytes = low, high, digests, n_bytes

    def at(self, depth: int) -> bytes:
        start = (depth - self.low) * WIDTH
        return self.digests[start : start + WIDTH]

    def cut(self, high: int) -> Path:
        """The path down to ``high`` only."""
        n = high - self.low + 1
        return Path(self.low, high, self.digests[: n * WIDTH], self.n_bytes[:n])


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Sequences by prefix digests, with numbers added up per subtree and the least id of each.

    The trie of a band begins at the band's first depth; digests tell the bands apart. Node 0 is the
    root of depth 0, -1 stands above the nodes of later bands.
    """

    def __init__(self, columns: int):
        self.handles: dict[bytes, int] = {}
        self.first: dict[bytes, int] = {}
        self.up, self.top, self.end = [-1], [0], [0]
        self.path = [Path(0, 0, ROOT, np.zeros(1, np.int64))]
        self.sums, self.here, self.least = [[0] * columns], [0], [None]
        self.columns, self.size = columns, 1  # depths and nodes

    def _add(self, up: int, top: int, end: int, path: Path) -> int:
        node = len(self.up)
        self.up.append(up)
        self.top.append(top)
        self.end.append(end)
        self.path.append(path)
        self.sums.append([0] * self.columns)
        self.here.append(0)
        self.least.append(None)
        self.size += 1
        self._hash(node)
        return node

    def _hash(self, node: int) -> None:
        path, top = self.path[node], self.top[node]
        self.first[path.at(top + 1)] = node
        self.handles[path.at(two_fattest(top, self.end[node]))] = node

    def locate(self, path: Path) -> tuple[int, int, int]:
        """(deepest node wholly on the path, exit node below it or -1, depth shared with it)."""
        low, high = path.low, path.high
        node, low_known, exit_node = (0 if low == 0 else -1), low, -1
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(path.at(depth), -1)
            if found < 0:
                high = depth - 1
                continue
            end = self.end[found]
            if end > path.high or self.path[found].at(end) != path.at(end):
                exit_node, low_known = found, depth
                node = self.up[found]
                break
            node, low = found, end
        if exit_node < 0:
            low_known = low
            if low < path.high:
                exit_node = self.first.get(path.at(low + 1), -1)
        if exit_node < 0:
            return node, -1, low_known
        # Prefix digests agree up to the shared depth and nowhere behind it.
        other, a, b = self.path[exit_node], low_known, min(path.high, self.end[exit_node])
        while a < b:
            middle = (a + b + 1) // 2
            if other.at(middle) == path.at(middle):
                a = middle
            else:
                b = middle - 1
        return node, exit_node, a

    def insert(self, path: Path, ident: int, sums: Iterable[int], here: int) -> None:
        """Add a sequence; ``sums`` count for all its prefixes, ``here`` for its last one only."""
        node, exit_node, shared = self.locate(path)
        if exit_node >= 0 and shared > self.top[exit_node]:
            if shared < self.end[exit_node]:
                middle = self._add(self.up[exit_node], self.top[exit_node], shared, self.path[exit_node])
                self.up[exit_node], self.top[exit_node] = middle, shared
                self._hash(exit_node)
                node = middle
            else:
                node = exit_node
        if shared < path.high:
            node = self._add(node, shared, path.high, path)
            self.size += path.high - shared
        if node < 0:  # a later band without turns does not exist
            return
        for i, x in enumerate(sums):
            self.sums[node][i] += x
        self.here[node] += here
        self.least[node] = ident if self.least[node] is None else min(ident, self.least[node])

    def expanded(self) -> tuple | None:
        """One entry per depth of every edge: digests, least ids, bytes up to the depth before and
        up to this one, sums, here. The trie cannot be added to afterwards."""
        for node in sorted(range(len(self.up)), key=self.end.__getitem__, reverse=True):
            up = self.up[node]
            if up < 0 or self.least[node] is None:
                continue
            self.least[up] = self.least[node] if self.least[up] is None else min(self.least[up], self.least[node])
            for i, x in enumerate(self.sums[node]):
                self.sums[up][i] += x
        nodes = [i for i, x in enumerate(self.least) if x is not None]
        if not nodes:
            return None
        end = np.array(self.end)[nodes]
        top = np.minimum(np.array(self.top)[nodes], end - 1)  # the root is a depth without an edge
        size = end - top
        edges = [(self.path[i], t + 1, e + 1) for i, t, e in zip(nodes, top.tolist(), end.tolist())]
        digests = b"".join(p.digests[(t - p.low) * WIDTH : (e - p.low) * WIDTH] for p, t, e in edges)
        n_bytes = np.concatenate([p.n_bytes[t - p.low : e - p.low] for p, t, e in edges])
        before = np.concatenate([p.n_bytes[max(0, t - 1 - p.low) : max(1, e - 1 - p.low)] for p, t, e in edges])
        here = np.zeros(len(before), np.int64)
        here[np.cumsum(size) - 1] = np.array(self.here)[nodes]
        least = np.repeat(np.array([self.least[i] for i in nodes], np.int64), size)
        sums = np.repeat(np.array(self.sums, np.int64)[nodes], size, axis=0)
        listed = [digests[i : i + WIDTH] for i in range(0, len(digests), WIDTH)]
        return listed, least, before, n_bytes, sums, here


def read_paths(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(id, n, path, further columns) of each row with the first columns of ``paths``."""
    turns = batch.column("turns")
    flat = turns.flatten()
    field = {f.name: i for i, f in enumerate(flat.type)}
    columns = [flat.field(field[f"l{i}"]).to_numpy(zero_copy_only=False) for i in range(LANES)]
    lanes = np.stack(columns, 1) if len(flat) else np.zeros((0, LANES), np.int64)
    n_bytes = flat.field(field["n_bytes"]).to_numpy(zero_copy_only=False)
    sizes = [0 if x is None else x for x in turns.value_lengths().to_pylist()]
    before = np.array(batch.column("before").to_pylist(), np.int64).reshape(-1, LANES + 1)
    rest = [batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names) if name not in ("turns", "before")]
    at = 0
    for row, size in enumerate(sizes):
        mine = slice(at, at + size)
        at += size
        ident, n, band, *more = (column[row] for column in rest)
        digests = np.cumsum(np.concatenate((before[row : row + 1, :LANES], lanes[mine])), 0) & MASK
        sums = np.cumsum(np.concatenate((before[row, LANES:], n_bytes[mine])))
        low = band * BAND
        yield ident, n, Path(low, low + size, digests.astype(">u4").tobytes(), sums), more


def _tried(batches: Iterator[pa.RecordBatch], columns: int, put, rows) -> Iterator[pa.RecordBatch]:
    """Insert every path with ``put``; ``rows`` turns a full trie, and the last one, into a batch."""
    trie = ZFastTrie(columns)
    for batch in batches:
        for row in read_paths(batch):
            put(trie, *row)
            if trie.size > MOST:
                yield from rows(trie)
                trie = ZFastTrie(columns)
    yield from rows(trie)


MEMBERS = "digest binary, id long, members long, ends long, n_bytes long"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of this task's tries: digest, least id, members, members that end there, last text."""

    def put(trie: ZFastTrie, ident: int, n: int, path: Path, _) -> None:
        trie.insert(path, ident, (1,), int(path.high == n))

    def rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        if (found := trie.expanded()) is not None:
            digests, least, before, n_bytes, sums, here = found
            arrays = [pa.array(digests, pa.binary()), *map(pa.array, (least, sums[:, 0], here, n_bytes - before))]
            yield pa.RecordBatch.from_arrays(arrays, names=["digest", "id", "members", "ends", "n_bytes"])

    yield from _tried(batches, 1, put, rows)


#: What the second pass writes; a node's own row has an id, the others hold sums.
NODE = (
    "digest binary, conv_id long, depth long, above binary, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)
_NODE = pa.schema([
    ("digest", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("above", pa.binary()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own rows of all nodes, and what conversations that leave a path add to the nodes above."""
    own: list[list] = [[] for _ in _NODE]

    def put(trie: ZFastTrie, ident: int, n: int, path: Path, more: list) -> None:
        owned, leaf, shared_bytes = more
        leaves = n - owned  # where it leaves the trie of the smaller ones; -1 for the root's owner
        for depth in range(max(leaves + 1, path.low + (path.low > 0)), path.high + 1):
            above = path.at(depth - 1) if depth == leaves + 1 and depth else None
            row = (path.at(depth), ident, depth, above, 1, int(depth < n), leaf, 0)
            for column, x in zip(own, row):
                column.append(x)
        if leaves >= path.low + (path.low > 0):
            part = path.cut(min(leaves, path.high))
            trie.insert(part, ident, (1, leaf, shared_bytes), int(part.high == leaves and owned > 0))
        trie.size += max(0, path.high - leaves)

    def rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(own, _NODE)], schema=_NODE)
        for column in own:
            column.clear()
        if (found := trie.expanded()) is not None:
            digests, _, before, _, sums, here = found
            none = pa.nulls(len(here), pa.int64())
            numbers = (sums[:, 0], here, sums[:, 1], sums[:, 2] - sums[:, 0] * before)
            arrays = [pa.array(digests, pa.binary()), none, none, pa.nulls(len(here), pa.binary()), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_NODE)

    yield from _tried(batches, 3, put, rows)


# -- ids at the ends of paths --------------------------------------------------------------------
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, place in the batch, rows) of equal neighbours in the first column, batch by batch."""
    for batch in batches:
        keys = batch.column(0).to_pylist()
        begin = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                yield keys[begin], batch.slice(begin, i - begin)
                begin = i


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal digests as texts of at most CHUNK ids, with the first id of each."""
    out: list[list] = [[], [], []]
    for digest, run in _runs(batches):
        ids = run.column(1).to_pylist()
        for at in range(0, len(ids), CHUNK):
            part = ids[at : at + CHUNK]
            for column, x in zip(out, (digest, part[0], ",".join(map(str, part)))):
                column.append(x)
        if len(out[0]) >= CHUNK:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), names=["digest", "id", "ids"])
            out = [[], [], []]
    types = (pa.binary(), pa.int64(), pa.string())
    arrays = [pa.array(c, t) for c, t in zip(out, types)]
    yield pa.RecordBatch.from_arrays(arrays, names=["digest", "id", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of all ids of a digest, fed chunk by chunk."""
    last, sha, out = None, hashlib.sha256(), ([], [])

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["digest", "ends_sha256"])

    for digest, run in _runs(batches):
        if digest != last:
            if last is not None:
                out[0].append(last)
                out[1].append(sha.hexdigest())
            if len(out[0]) >= CHUNK:
                yield batch()
                out = ([], [])
            last, sha = digest, hashlib.sha256()
        else:
            sha.update(b",")
        sha.update(",".join(run.column(2).to_pylist()).encode())
    if last is not None:
        out[0].append(last)
        out[1].append(sha.hexdigest())
    yield batch()


def ends(whole: DataFrame) -> DataFrame:
    """(digest, ends_sha256): the digest of all ids with equal ``digest``, ascending, comma-joined.

    Ranges of (digest, id) are turned into chunks in parallel; only the texts of a digest's chunks
    meet in one task, where they pass one after another.
    """
    ranged = whole.repartitionByRange(slices(whole), "digest", "id").sortWithinPartitions("digest", "id")
    chunks = ranged.mapInArrow(_chunks, "digest binary, id long, ids string")
    together = chunks.repartition("digest").sortWithinPartitions("digest", "id")
    return together.mapInArrow(_hashed, "digest binary, ends_sha256 string")


# -- the operator --------------------------------------------------------------------------------
def trie_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``convs`` (id, n), whose turns are (id, depth, turn_hash, n_bytes).

    Per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless
    nodes below or itself), saved_tokens (over the subtree, members beyond the first times bytes of
    the last text), ends_sha256. Conversations without turns end at the root. Sequences are equal if
    the 128-bit digests of all their turns are. An empty table has no nodes, not even a root.
    """
    known = staged(paths(turns, convs), "paths")
    found = known.select("id", "n", "band", "before", "turns").mapInArrow(_members, MEMBERS)
    nodes = found.groupBy("digest").agg(
        F.min("id").alias("id"),
        F.sum("members").alias("members"),
        F.sum("ends").alias("ends"),
        F.max("n_bytes").alias("n_bytes"),
    )
    owners = nodes.groupBy("id").agg(
        F.count(F.lit(1)).alias("owned"),
        F.max((F.col("members") == F.col("ends")).cast("long")).alias("leaf"),
        F.sum("n_bytes").alias("owned_bytes"),
    )
    zero = F.lit(0).cast("long")
    told = known.join(staged(owners, "owners"), "id", "left").select(
        "id",
        "n",
        "band",
        "before",
        "turns",
        F.coalesce("owned", zero).alias("owned"),
        F.coalesce("leaf", zero).alias("leaf"),
        (F.col("total_bytes") - F.coalesce("owned_bytes", zero)).alias("shared_bytes"),
    )
    whole = known.where("whole IS NOT NULL").select(F.col("whole").alias("digest"), "id")
    rows = told.mapInArrow(_subtrees, NODE).withColumn("ends_sha256", F.lit(None).cast("string"))
    rows = rows.unionByName(ends(whole), allowMissingColumns=True)
    merged = staged(
        rows.groupBy("digest").agg(
            *(F.max(c).alias(c) for c in ("conv_id", "depth", "above", "ends_sha256")),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        ),
        "nodes",
    )
    nobody = F.lit(hashlib.sha256().hexdigest())
    # Inside its own part a path has one owner; only the first node there has another's for parent.
    inner = merged.where("above IS NULL").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))
    )
    owner = merged.select(F.col("digest").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    tops = merged.where("above IS NOT NULL").join(owner, "above")
    return inner.unionByName(tops).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )


def conversation_trie(convs: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """``trie_nodes`` of conversations (conv_id, turn, role, text) whose first turns are their
    family's (``rebranched``). Null roles and texts count as empty, rows without conv_id are left
    out, repeated rows are turns of their own; other columns are ignored."""
    return trie_nodes(*rebranched(numbered(convs), family, heads))
