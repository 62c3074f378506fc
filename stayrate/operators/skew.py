"""Hot keys: facts of which one user may own a large share.

Aggregates need no help here, since Spark combines them before the shuffle. Operators that must
bring the *rows* of a user together in windows treat hot users apart:

* a key is hot when it has more than ``rows_per_task`` rows and more than one in ``MAX_HOT_KEYS``
  of all rows. However the data grows or is distributed, no more than ``MAX_HOT_KEYS`` keys can
  have that many, so a table with a row per hot key stays at some tens of MB and is broadcast;
* rows of hot keys are joined to broadcast data and never shuffled by their key;
* rows of all other keys are shuffled by key.

Without hot keys the broadcast is empty and adaptive execution drops the hot branch unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 1_000_000


def hot_keys(facts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with too many rows for one task: a count of the key column alone.

    The total that bounds their number is added up from the same counts, so the shuffle behind
    them is shared.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = counts.agg(F.sum("n") / MAX_HOT_KEYS).scalar()
    return counts.where((F.col("n") > rows_per_task) & (F.col("n") > share)).select(key)


def without_hot(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither hot nor NULL."""
    kept = facts.where(F.col(key).isNotNull())
    return kept.join(F.broadcast(hot), key, "left_anti")


def only_hot(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Rows of hot keys: a broadcast join, no shuffle of facts."""
    return facts.join(F.broadcast(hot), key, "left_semi")


def attach(facts: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join of facts to a table with one row per key.

    Every fact row is kept once; columns of unknown and NULL keys are NULL. Facts are read once:
    the engine splits the partitions of hot and NULL keys on the left side by itself.
    """
    return facts.join(per_key, key, "left")
