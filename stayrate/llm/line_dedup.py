"""Near-duplicate lines by a segment-partition edit join, with built-in expressions only.

Two lines within ``edits`` edits of each other share, unchanged, at least one of the ``edits`` + 1
segments into which the shorter is cut, at a place that its length and the segment's number confine
to a few positions. Each line lists its segments under (number, length, hash), and probes with the
few substrings that could match, for its own length and up to ``edits`` less. Only hashes of lines
are joined. The join itself also requires letter counts that so few edits allow, which keeps lines
that merely share a common beginning from becoming pairs. Pairs are verified by a bit-parallel
automaton over the band of 2 ``edits`` + 1 diagonals; linked lines form classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of
from stayrate.llm.components import components

#: Letters whose counts are compared in the join, with bits for each count, and the parts of a line
#: that are looked for in the other before a pair is verified.
LETTERS, BITS, CHUNKS = "etaonirs", 7, 12
MASK = (1 << BITS) - 1


def lines_of(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(doc, number, line, id) of every line long enough to be compared.

    A line's id is its hash with its length in bytes.
    """
    text = text_of(text_col)
    doc = F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h")
    )
    rows = docs.select(doc.alias("doc"), F.posexplode(F.split(text, "\n", -1)).alias("number", "line"))
    rows = rows.where(F.length("line") >= least_chars)
    return rows.withColumn("id", _line_id())


def _line_id() -> Column:
    return F.struct(F.xxhash64("line").alias("h"), F.octet_length("line").alias("size"))


def _letter_counts() -> Column:
    """Counts of some letters of a line, packed into one long."""
    counts = F.lit(0).cast("long")
    for place, letter in enumerate(LETTERS):
        n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(letter)))
        counts = counts.bitwiseOR(F.shiftleft(n.bitwiseAND(F.lit(MASK)).cast("long"), BITS * place))
    return counts


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(id, line, counts) of every different line; equal lines are combined before they are shuffled."""
    once = lines.select("line").distinct()
    return staged(once.select(_line_id().alias("id"), "line", _letter_counts().alias("counts")), "distinct")


def _bounds(length: Column, segment: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and size of a segment of a line of this length; the last ones are longer."""
    parts = edits + 1
    size, longer = F.floor(length / parts).cast("int"), F.pmod(length, F.lit(parts))
    short = F.lit(parts) - longer  # so many segments of the smaller size come first
    start = size * segment + F.greatest(F.lit(segment) - short, F.lit(0))
    return start, size + (F.lit(segment) >= short).cast("int")


def _key(length: Column, segment: int, start: Column, size: Column, edits: int) -> Column:
    piece = F.substr(F.col("line"), start + 1, size)
    return F.xxhash64(F.lit(segment), length, piece)


def segment_keys(edits: int) -> Column:
    """The keys under which a line is listed."""
    length = F.length("line")
    places = ((s, *_bounds(length, s, edits)) for s in range(edits + 1))
    return F.array(*(_key(length, s, start, size, edits) for s, start, size in places))


def probe_keys(edits: int) -> Column:
    """The keys under which a line finds all lines of its length or up to ``edits`` less.

    Only starts are tried at which the edits left and right of the segment can add up.
    """
    keys = []
    for less in range(edits + 1):
        length = F.length("line") - less
        for s in range(edits + 1):
            start, size = _bounds(length, s, edits)
            for shift in range(max(-s, less - (edits - s)), min(s, less + (edits - s)) + 1):
                at = start + shift
                inside = (at >= 0) & (at + size <= F.length("line"))
                keys.append(F.when(inside, _key(length, s, at, size, edits)))
    return F.array(*keys)


def _letters_allow(a: Column, b: Column, edits: int) -> Column:
    """Whether the letter counts differ by no more than the edits can change them."""
    total = F.lit(0)
    for place in range(len(LETTERS)):
        x, y = (F.shiftright(c, BITS * place).bitwiseAND(F.lit(MASK)) for c in (a, b))
        apart = F.abs(x - y)
        total = total + F.least(apart, F.lit(MASK + 1) - apart)
    return total <= 2 * edits


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """Pairs (a, b) of ids of different lines that share a segment where it may stand, a < b."""
    listed = lines.select(
        F.col("id").alias("a"), F.col("counts").alias("n"), F.explode(segment_keys(edits)).alias("key")
    )
    keys = F.explode(F.array_distinct(probe_keys(edits))).alias("key")
    probes = lines.select(F.col("id").alias("b"), F.col("counts").alias("m"), keys)
    probes = probes.where("key IS NOT NULL")
    differ = (F.col("a.h") != F.col("b.h")) | (F.col("a.size") != F.col("b.size"))
    near = _letters_allow(F.col("n"), F.col("m"), edits)
    found = listed.join(probes, (listed["key"] == probes["key"]) & differ & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _chunks_found(a: str, b: str, edits: int) -> Column:
    """Whether all parts of ``a`` but one per edit stand in ``b``, at most ``edits`` places away."""
    n, missing = F.length(F.col(a)), F.lit(0)
    for c in range(CHUNKS):
        start = F.floor(n * c / CHUNKS).cast("int")
        size = F.floor(n * (c + 1) / CHUNKS).cast("int") - start
        low = F.greatest(start - edits, F.lit(0))
        around = F.substr(F.col(b), low + 1, start - low + size + edits)
        found = F.contains(around, F.substr(F.col(a), start + 1, size))
        missing = missing + F.when(found, 0).otherwise(1)
    return missing <= edits


def within(a: str, b: str, edits: int) -> Column:
    """Whether two strings are within ``edits`` edits: a bit-parallel automaton over the band.

    Bit d of row e says that the part of ``a`` read so far and the part of ``b`` that is d - edits
    longer are at most e edits apart. The rows are packed into one long. The columns ``a``_chars and
    ``b``_chars hold the characters of the strings.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    x, y = F.col(f"{a}_chars"), F.col(f"{b}_chars")
    n, m = F.length(F.col(a)), F.length(F.col(b))

    def equal_bits(i: Column) -> Column:
        bits = F.lit(0).cast("long")
        for d in range(width):
            same = F.get(y, i + (d - edits)) == F.get(x, i)
            bits = bits + F.when(same, F.lit(1 << d)).otherwise(0)
        return bits

    def step(state: Column, equal: Column) -> Column:
        old = [F.shiftright(state, width * e).bitwiseAND(F.lit(full)) for e in range(edits + 1)]
        new = [old[0].bitwiseAND(equal)]
        for e in range(1, edits + 1):
            row = old[e].bitwiseAND(equal).bitwiseOR(old[e - 1])
            row = row.bitwiseOR(F.shiftright(old[e - 1], 1)).bitwiseOR(F.shiftleft(new[e - 1], 1))
            new.append(row.bitwiseAND(F.lit(full)))
        out = new[0]
        for e in range(1, edits + 1):
            out = out.bitwiseOR(F.shiftleft(new[e], width * e))
        return out

    start = sum(((((1 << (e + 1)) - 1) << edits) & full) << (width * e) for e in range(edits + 1))
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    end = F.aggregate(F.transform(places, equal_bits), F.lit(start).cast("long"), step)
    last = F.shiftright(end, width * edits).bitwiseAND(F.lit(full))
    hit = F.getbit(last, F.greatest(F.lit(0), F.least(m - n + edits, F.lit(width - 1)))) == 1
    return (F.abs(m - n) <= edits) & hit


def close_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """Verified pairs (a, b) of line ids."""
    lines = distinct_lines(lines)
    pairs = staged(candidate_pairs(lines, edits), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    texts = lines.select("id", "line").join(wanted.distinct(), "id", "left_semi")
    # Written out, else the characters would be split anew at every step of the automaton.
    texts = staged(texts.withColumn("chars", F.split("line", "")), "lines")
    x, y = (
        texts.select(
            F.col("id").alias(end), F.col("line").alias(name), F.col("chars").alias(f"{name}_chars")
        )
        for end, name in (("a", "x"), ("b", "y"))
    )
    likely = pairs.join(x, "a").join(y, "b").where(_chunks_found("x", "y", edits))
    return likely.where(within("x", "y", edits)).select("a", "b")


def line_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = 1,
    least_chars: int = 20,
    equal_short: bool = False,
) -> DataFrame:
    """One row per line of at least ``least_chars`` characters: doc, number, line_id, class_id, kept.

    Lines are the ``\\n``-separated parts of a text; equal lines and lines linked by at most
    ``edits`` edits form a class, of which the line of the smallest document id and number is kept.
    Null texts have no lines; null ids come last; rows equal in id and text share one verdict.
    With ``equal_short`` there are also rows for shorter lines that are not blank; of those only
    equal ones form a class.
    """
    long = lines_of(docs, id_col, text_col, least_chars)
    linked = staged(components(close_pairs(long, edits), "a", "b"), "classes")
    lines = long
    if equal_short:
        compared = (F.length("line") >= least_chars) | F.col("line").rlike(r"\S")
        lines = lines_of(docs, id_col, text_col, 1).where(compared)
    places = lines.select("doc", "number", "id")
    classed = places.join(linked, places["id"] == linked["node"], "left").select(
        "doc", "number", "id", F.coalesce("component", "id").alias("class")
    )
    place = F.struct("doc", "number")
    first = classed.groupBy("class").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Written first, so that the join splits the lines of a class that fills much of the table.
    shared = staged(first.where("first <> last").select("class", "first"), "shared")
    found = classed.join(shared, "class", "left")
    return found.select(
        F.col("doc"),
        F.col("number").alias("line_number"),
        F.col("id.h").alias("line_id"),
        F.col("class.h").alias("class_id"),
        F.coalesce(F.col("first") == F.struct("doc", "number"), F.lit(True)).alias("kept"),
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = 1,
    least_chars: int = 20,
    equal_short: bool = False,
) -> DataFrame:
    """One row per document: id, n_lines, n_removed, class_ids (of its removed lines, sorted).

    See ``line_classes``; shorter lines that are blank, and without ``equal_short`` all shorter lines,
    are never removed, a null text has no lines, documents that lose none have an empty list. Other
    columns are ignored.
    """
    gone = line_classes(docs, id_col, text_col, edits, least_chars, equal_short).where("NOT kept")
    per_doc = gone.groupBy("doc").agg(
        F.collect_set("line_number").alias("numbers"), F.collect_set("class_id").alias("classes")
    )
    text = text_of(text_col)
    doc = F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h")
    )
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    small = docs.select(doc.alias("doc"), n_lines.cast("long").alias("n_lines"))
    empty = F.array().cast("array<bigint>")
    return small.join(per_doc, "doc", "left").select(
        F.col("doc.id").alias(id_col),
        "n_lines",
        F.greatest(F.size(F.coalesce("numbers", F.array().cast("array<int>"))), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.sort_array("classes"), empty).alias("class_ids"),
    )
