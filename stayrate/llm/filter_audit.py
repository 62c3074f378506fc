"""How filters interact: what each removes, in every order and step, and what is lost with it.

Every filter's failing rows are stored as a table of ids. What a filter removes at a step depends on
the *set* of filters before it, not on their order, so there are 2^(n-1) prefixes per filter. The
failing ids of a filter are held against each of these prefixes by left-anti joins with the id
tables of the filters in it; what is left is removed there, the rest is redundant. Left-semi joins
with the id tables of labels give the losses of each kind.

The ids are shuffled once, before the prefixes are spelt out: the copies for the prefixes and the
joins of all filters stay in the partition of their id. Only counts leave it.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import string
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of

# -- the five filters ----------------------------------------------------------------------------
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 2
SYMBOLS = "[#$%&*|]"
UPPER = string.ascii_uppercase.encode()
#: Texts that are measured at a time.
ROWS = 256


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, part, verdicts of the filters that see one text only, SHA-256 of the text."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            texts = batch.column(2)
            points = pc.utf8_length(texts).to_pylist()
            symbols = pc.match_substring_regex(texts, SYMBOLS)
            few, dull, loud, digests = [], [], [], []
            for text, n in zip(texts.cast(pa.binary()).to_pylist(), points):
                words = text.split()  # bytes: at the ASCII white space, nothing else
                few.append(len(words) < MIN_WORDS)
                dull.append(100 * len(set(words)) < MIN_DISTINCT * len(words))
                loud.append(100 * (len(text) - len(text.translate(None, UPPER))) > MAX_UPPER * n)
                digests.append(hashlib.sha256(text).digest())
            flags = [*(pa.array(x, pa.bool_()) for x in (few, dull, loud)), symbols]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *flags, pa.array(digests, pa.binary())],
                names=["id", "part", *FILTERS[:4], "digest"],
            )


def failing_ids(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame]]:
    """(rows, failing rows per filter, labelled rows per loss), each a stored table of (row, part).

    A row of ``docs`` is a document, also when its id repeats. Null texts are empty, null parts the
    empty string. A null id is smaller than none and has no labels; of contradicting labels of one id
    any that says 1 counts.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(part_col).alias("part"), text_of(text_col).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, part string, A boolean, B boolean, C boolean, D boolean, digest binary"
    measured = rows.mapInArrow(_measured, schema).withColumn("row", F.monotonically_increasing_id())
    seen = staged(measured, "measured")
    # Written first, so that a join splits the rows of a text that fills much of the table.
    copies = seen.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    copies = staged(copies.where("least < most").select("digest", "least"), "copies")
    later = seen.select("row", "part", "id", "digest").join(copies, "digest").where("id > least")
    failing = {f: seen.where(F.col(f)).select("row", "part") for f in FILTERS[:4]}
    failing["E"] = later.select("row", "part")
    known = seen.select("row", "part", "id")
    flags = {
        loss: known.join(labels.where(F.col(label) == 1).select(F.col(id_col).alias("id")), "id", "left_semi").select("row", "part")
        for loss, label in (("good_lost", "quality"), ("toxic_lost", "toxic"))
    }
    return (
        seen.select("row", "part"),
        {f: staged(t, f"failing-{f}") for f, t in failing.items()},
        {loss: staged(t, loss) for loss, t in flags.items()},
    )


# -- prefixes --------------------------------------------------------------------------------------
def _prefixes(n: int) -> list[list[int]]:
    """Per filter all sets of other filters, as bits."""
    return [[s for s in range(1 << n) if not s >> i & 1] for i in range(n)]


def removals(failing: Mapping[str, DataFrame], flags: Mapping[str, DataFrame]) -> DataFrame:
    """(part, filter, prefix, kind, n): rows that a filter removes after a set of others.

    ``kind`` is 0 for all rows and i for those in the i-th table of ``flags``.
    """
    names = list(failing)
    own = reduce(
        DataFrame.unionByName,
        [t.select("row", "part", F.lit(i).alias("filter")) for i, t in enumerate(failing.values())],
    )
    kinds = [own.withColumn("kind", F.lit(0))]
    for i, table in enumerate(flags.values(), start=1):
        kinds.append(own.join(table.select("row"), "row", "left_semi").withColumn("kind", F.lit(i)))
    rows = reduce(DataFrame.unionByName, kinds).repartition("row")
    sets = F.from_json(F.lit(json.dumps(_prefixes(len(names)))), "array<array<int>>")
    left = rows.select("*", F.explode(F.get(sets, "filter")).alias("prefix")).alias("left")
    for i, name in enumerate(names):
        right = failing[name].select(F.col("row").alias("out"))
        inside = F.col("prefix").bitwiseAND(F.lit(1 << i)) != 0
        left = left.join(right, (F.col("row") == F.col("out")) & inside, "left_anti")
    return left.groupBy("part", "filter", "prefix", "kind").agg(F.count(F.lit(1)).alias("n"))


def interactions(
    rows: DataFrame, failing: Mapping[str, DataFrame], flags: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per part, order of the filters and step: filter_order, step, kept, removed,
    redundant, unique_fails, one column per table of ``flags``, shapley.

    ``failing`` and ``flags`` hold a table (row, part) each, ``rows`` all rows. Steps that remove
    nothing are returned with zeros; a table without rows gives none.
    """
    names, n, kinds = list(failing), len(failing), 1 + len(flags)

    def place(i: int, prefix: int, kind: int = 0) -> int:
        return (i << n | prefix) * kinds + kind

    steps = []
    for order in itertools.permutations(range(n)):
        prefix, gone = 0, []
        for step, i in enumerate(order, start=1):
            gone.append(place(i, prefix))
            steps.append({
                "filter_order": "".join(names[j] for j in order), "step": step, "filter": i,
                "at": gone[-1], "gone": list(gone),
            })
            prefix |= 1 << i
    step_type = "array<struct<filter_order string, step int, filter int, at int, gone array<int>>>"

    # At most n * 2^n * kinds numbers a part: one array, in which every step looks up its own.
    counted = removals(failing, flags)
    key = ((F.shiftleft("filter", n) + F.col("prefix")) * kinds + F.col("kind")).cast("int")
    entries = counted.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(key, "n"))).alias("found"))
    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    zero = F.lit(0).cast("bigint")
    every = F.sequence(F.lit(0), F.lit(place(n, 0) - 1))
    numbers = F.transform(every, lambda i: F.coalesce(F.try_element_at("found", i), zero))
    known = totals.join(entries, "part", "left").select("part", "total", numbers.alias("n"))

    def number(at: Column | int) -> Column:
        return F.get("n", at if isinstance(at, Column) else F.lit(at))

    def summed(places: list[tuple[int, int]]) -> Column:
        return reduce(Column.__add__, (number(at) * weight for at, weight in places))

    def orders(prefix: int) -> int:
        """In how many orders exactly these filters stand before a given other one."""
        size = prefix.bit_count()
        return math.factorial(size) * math.factorial(n - 1 - size)

    everything = (1 << n) - 1
    shares = [summed([(place(i, s), orders(s)) for s in sets]) for i, sets in enumerate(_prefixes(n))]
    with_shares = known.select(
        "part", "total", "n",
        F.array(*shares).alias("shapley"),
        F.array(*(number(place(i, 0)) for i in range(n))).alias("fails"),
        F.array(*(number(place(i, everything ^ 1 << i)) for i in range(n))).alias("alone"),
    )
    listed = F.from_json(F.lit(json.dumps(steps)), step_type)
    each = with_shares.select("*", F.explode(listed).alias("s")).select("*", "s.*")
    gone = F.aggregate("gone", zero, lambda so_far, at: so_far + F.get("n", at))
    removed = number(F.col("at"))
    return each.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - gone).alias("kept"),
        removed.alias("removed"),
        (F.get("fails", "filter") - removed).alias("redundant"),
        F.get("alone", "filter").alias("unique_fails"),
        *(number(F.col("at") + i).alias(name) for i, name in enumerate(flags, start=1)),
        F.get("shapley", "filter").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``interactions`` of the five filters on ``documents``, per source; see ``failing_ids`` for
    nulls and repeated rows. Other columns are ignored."""
    return interactions(*failing_ids(docs, labels))
