"""Documents to packed sequences: quality, exact copies, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``. Nulls, empty and very long texts, repeated rows and empty
tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from stayrate.llm import co_training, exact_dedup, packing, simhash_near, suffix_dedup  # noqa: E402
from stayrate.llm.common import staged, table  # noqa: E402


#: The stage ``repeats`` takes out passages of at least so many bytes (found by anchors of half that
#: length) and words. Fifty-one words of running text are some 290 bytes; 200 leave room for short words.
REPEAT_BYTES, REPEAT_WORDS = 200, 51


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return co_training.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id."""
    return simhash_near.drop_near(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words that stand anywhere else too.

    Shorter passages, such as stock phrases, stay. A text of which nothing is left goes.
    """
    return suffix_dedup.without_repeats(
        docs, size=REPEAT_BYTES, anchor=REPEAT_BYTES // 2, least_words=REPEAT_WORDS
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts with their ids, placed in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("repeats", repeats),
    ("packed", packed),
]

#: No stage but ``exact`` can be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
