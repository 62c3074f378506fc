"""The stages against plain versions of the same decisions, each on its own input."""

import itertools
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from conftest import TESTDATA
from stayrate.llm import co_training
from test_operators import LOWER, ODD, check_packing, classes_of, plain_fingerprint

SF = f"{TESTDATA}/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def plain_passages(texts, size, least_words):
    """The texts without repeated strings of ``size`` bytes that together hold ``least_words`` words."""
    data = {d: t.encode() for d, t in texts.items()}
    counts = Counter(x[i : i + size] for x in data.values() for i in range(len(x) - size + 1))
    out = {}
    for d, x in data.items():
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - size + 1):
            if counts[x[i : i + size]] > 1:
                gone[i : i + size] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0)).tolist()
        for begin, end in zip(edges[::2], edges[1::2]):
            if len(x[begin:end].split()) < least_words:
                gone[begin:end] = False
        out[d] = np.frombuffer(x, np.uint8)[~gone[:-1]].tobytes().decode("utf-8", "ignore")
    return out


def test_passages_of_over_fifty_words_leave_both_documents(spark):
    rng = random.Random(6)

    def words(n, letters="abcdefghijklmnopqrstuvwxyzé"):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(n))

    long, short = words(55), words(45)
    rows = [(i, words(80) + "\n" + (long if i < 2 else short) + "\n" + words(60), {"k": i}, "d", "t") for i in range(4)]
    rows += [(4, words(200), None, "d", None), (5, None, None, "d", "t"), (None, words(60), None, "d", "t")]
    # names that the operator might use itself, and a type that cannot be grouped
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,long>, _doc string, _text string")
    out = corpus_pipeline.repeats(spark, docs, SF)
    assert out.schema.names == docs.schema.names
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(rows)
    for i, text, extra, *_ in rows:
        kept = found[i].text
        if i in (0, 1):
            # equal bytes beside the passage, such as the line breaks, go with it
            assert len(set(long.split()) & set(kept.split())) <= 1
            assert 0 <= len(text) - len(kept) - len(long) <= 8
        else:
            assert kept == text
        assert found[i].extra == extra and found[i]._doc == "d"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact", "near", "repeats", "packed"]

    good = stages["quality"](spark, docs, SF)
    scores = co_training.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(by_id(good)) == {r.doc_id for r in scores.collect() if r.kept}

    exact = stages["exact"](spark, good, SF)
    latest = {}
    for r in good.collect():
        text = r.text.translate(LOWER)
        latest[text] = max(latest.get(text, r.doc_id), r.doc_id)
    assert sorted(by_id(exact)) == sorted(latest.values())

    near = stages["near"](spark, exact, SF)
    prints = {d: plain_fingerprint(r.text) for d, r in by_id(exact).items()}
    pairs = itertools.combinations(prints, 2)
    links = [p for p in pairs if (prints[p[0]] ^ prints[p[1]]).bit_count() <= 3]
    assert set(by_id(near)) == set(classes_of(prints, links).values())

    cut = stages["repeats"](spark, near, SF)
    before, after = by_id(near), by_id(cut)
    plain = plain_passages({d: r.text for d, r in before.items()}, 200, 51)
    for doc_id, r in before.items():
        if plain[doc_id] == "" != r.text:
            assert doc_id not in after
        elif plain[doc_id] == r.text:
            assert after[doc_id] == r
        else:
            assert after[doc_id].text == plain[doc_id]
            assert after[doc_id].n_chars == len(plain[doc_id])

    packed = stages["packed"](spark, cut, SF).collect()
    check_packing(packed, {d: r.text for d, r in after.items()}, 4096)
    whole = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.start, r.length) for r in whole.collect()} == {
        (r.doc_id, r.start, r.length) for r in packed
    }
    for stage in ("quality", "exact", "near", "repeats"):
        assert stages[stage](spark, docs, SF).schema.names == docs.schema.names


def test_stages_take_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, row long"
    odd = spark.createDataFrame([(*r, "x", 1) for r in ODD], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packed":
                assert out.columns == docs.columns
                assert out.count() <= docs.count()


def test_packed_pieces_hold_their_ids(spark):
    docs = spark.createDataFrame([(1, "one two " * 3000), (2, None), (3, "three")], "doc_id long, text string")
    rows = corpus_pipeline.packed(spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3} and len(rows) > 3
    for r in rows:
        assert len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
