"""Bounded samples of labelled documents for the models that are trained here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    id_col: str,
    columns: list[str],
    docs_id: str | None = None,
) -> DataFrame:
    """At most ``rows`` labelled documents: id, ``columns`` and the label as 0 or 1.

    Which ones follows from a hash of their ids. Rows without id or label are left out, of
    contradicting labels the lower one counts, of documents with one id the least by ``columns``.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    known = known.where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    wanted = docs.select(F.col(docs_id or id_col).alias("id"), F.struct(*columns).alias("row"))
    found = wanted.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("row").alias("row"))
    return found.select("id", "y", "row.*")
