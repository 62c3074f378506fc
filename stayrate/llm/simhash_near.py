"""SimHash fingerprints and near-duplicates by multi-index hashing.

A fingerprint is cut into as many segments as let one of them differ by at most one bit whenever
two fingerprints differ by at most ``max_bits`` (pigeonhole: two 32-bit segments for 3 bits). Each
distinct fingerprint is listed once per segment table; it probes each table with the Hamming ball
around its own segment, and matches are verified on all 64 bits. Equal fingerprints are combined
before any of this, so a large group of copies is one entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of
from stayrate.llm.components import components

SEED = 42
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without a word. Signed 64 bits."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII rules on bytes
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1]
    stops = ends[size - 1 :] - 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), stops[at : at + BLOCK].tolist())
        values = np.array([hashed(joined[i:j], SEED) for i, j in pairs], np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["id", "fp"]
            )

    return rows.mapInArrow(run, f"id {kind}, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def _keys(max_bits: int, ball: bool) -> Column:
    """Table keys of a fingerprint: its segments, and for probes all values one bit away."""
    keys = []
    for number, (shift, width) in enumerate(_segments(max_bits)):
        mask = (1 << width) - 1
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask if width < 64 else -1))
        flips = [0, *(1 << i for i in range(width))] if ball and max_bits else [0]
        for flip in flips:
            flip = flip - (1 << 64) if flip >= 1 << 63 else flip
            value = part.bitwiseXOR(F.lit(flip).cast("long"))
            keys.append(F.struct(F.lit(number).cast("byte").alias("seg"), value.alias("value")))
    return F.explode(F.array(*keys))


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` at most ``max_bits`` bits apart."""
    listed = distinct.select(F.col("fp").alias("a"), _keys(max_bits, ball=False).alias("key"))
    probes = distinct.select(F.col("fp").alias("b"), _keys(max_bits, ball=True).alias("key"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    on = (
        (listed["key.seg"] == probes["key.seg"])
        & (listed["key.value"] == probes["key.value"])
        & (F.col("a") < F.col("b"))
        & close
    )
    return listed.join(probes, on).select("a", "b").distinct()


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ by at most ``max_bits`` bits are linked; component_id is the
    smallest id a document can reach over links. Null and empty texts have fingerprint 0 and are
    linked like any other. Null ids never name a component unless all its ids are null. Rows that
    repeat are returned as often as they occur; other columns are ignored.
    """
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    linked = components(links(distinct.select("fp"), max_bits), "a", "b")
    classes = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    classes = staged(classes, "classes")
    names = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = classes.join(names, "component").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with all columns of ``docs``.

    The row with the smallest id stays, null ids last; of rows that share that id the one with the
    smallest hash. Groups are told apart by their texts, so null and repeated ids cost no group its row.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    row_hash = F.xxhash64(*names, *(c.isNull() for c in names))  # the hash alone passes over nulls
    name = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), row_hash.alias("h"))
    groups = near_groups(docs.select(name.alias("_name"), text_of(text_col).alias("_text")), "_name", "_text")
    keep = groups.select(F.col("component_id").alias("_name")).distinct()
    named = docs.select(name.alias("_name"), F.struct(*names).alias("_row"))
    kept = named.join(keep, "_name", "left_semi")
    return kept.groupBy("_name").agg(F.min("_row").alias("_row")).select("_row.*")
