"""Every operator against a plain, quadratic or textbook version of the same contract."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from conftest import TESTDATA
from stayrate.llm import byte_bpe, co_training, exact_dedup, line_crf, line_dedup, packing, queries
from stayrate.llm import simhash_near, style_tree, suffix_dedup, url_filter
from stayrate.llm import components as components_module
from stayrate.llm.components import components

SF = f"{TESTDATA}/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(f"[^{BLANK}]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD = [
    (1, None, "en", "a", 5),
    (2, "", None, None, None),
    (3, "One two three", "en", "a", 13),
    (3, "One two three", "en", "a", 13),
    (4, "one TWO three", "en", "a", 13),
    (None, "one two three", "en", "a", 13),
    (None, None, None, None, None),
    (5, "É É " * 3000 + "\n" + "word " * 20_000, "fr", "b", 0),
    (6, " \n\t\x0b x\x0c\r\n\n", "en", "a", -1),
    (7, "日本 ½ ²x İ <|endoftext|> it's", "ja", "c", 3),
]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns whose names operators use themselves."""
    extra = "id string, h string, kept string, key string, length string, row string"
    names = [f.split()[0] for f in extra.split(", ")]
    rows = [r + tuple("x" for _ in names) for r in ODD]
    return spark.createDataFrame(rows, f"{DOC}, {extra}")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


def collected(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def as_written(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 1 ----------------------------------------------------------------------------------------
def plain_statistics(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (
        len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed
    )


def test_line_statistics(spark, texts, odd):
    found = collected(queries.op1_line_crf(spark, SF))
    assert len(found) == len(texts)
    for doc_id, text in texts.items():
        assert tuple(found[doc_id])[1:7] == plain_statistics(text)
        assert not (found[doc_id].kept and found[doc_id].base_failed)
    rows = line_crf.judge_lines(odd, line_crf.NEUTRAL).collect()
    got = sorted((tuple(r)[:7] for r in rows), key=repr)
    assert got == sorted(((r[0], *plain_statistics(r[1] or "")) for r in ODD), key=repr)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for length in (1, 2, 5, 8):
        size = len(line_crf.FEATURES)
        crf = line_crf.LineCrf(rng.normal(size=(size, 2)), rng.normal(size=2), rng.normal(size=(2, 2)))
        x = rng.normal(size=(length, size))

        def score(path):
            steps = sum(crf.follow[a, b] for a, b in zip(path, path[1:]))
            return crf.first[path[0]] + steps + sum((x[i] @ crf.emit)[m] for i, m in enumerate(path))

        best = max(itertools.product((0, 1), repeat=length), key=score)
        assert tuple(crf.decode(x)) == best


def test_crf_gradient():
    rng = np.random.default_rng(2)
    x, real = rng.normal(size=(3, 4, 2)), np.array([[1, 1, 1, 1], [1, 0, 0, 0], [1, 1, 1, 0]], bool)
    y, weight = np.array([[0, 1, 1, 0], [1, 0, 0, 0], [1, 0, 1, 0]]), np.array([1.0, 0.5, 2.0])
    model = [rng.normal(size=s) for s in ((2, 2), (2,), (2, 2))]

    def likelihood(emit, first, follow):
        total = 0.0
        for chain, ok, marks, w in zip(x, real, y, weight):
            scores = chain[ok] @ emit
            paths = list(itertools.product((0, 1), repeat=len(scores)))
            values = [
                first[p[0]] + sum(scores[i, m] for i, m in enumerate(p))
                + sum(follow[a, b] for a, b in zip(p, p[1:]))
                for p in paths
            ]
            total += w * (values[paths.index(tuple(marks[ok]))] - np.logaddexp.reduce(values))
        return total

    for part, grad in zip(range(3), line_crf._gradient(x, real, y, weight, *model)):
        for at in np.ndindex(model[part].shape):
            up = [m.copy() for m in model]
            up[part][at] += 1e-6
            assert abs((likelihood(*up) - likelihood(*model)) / 1e-6 - grad[at]) < 1e-4


def test_crf_on_held_out_documents(spark):
    sf = f"{TESTDATA}/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    even = labels.where("doc_id % 2 = 0")
    found = collected(line_crf.judge_lines(docs, line_crf.fit(docs, even)))
    held = [r for r in labels.where("doc_id % 2 = 1").collect() if not found[r.doc_id].base_failed]
    right = sum(found[r.doc_id].kept == (r.quality == 1) for r in held)
    assert right >= 0.97 * len(held)


def test_lines_spliced_into_other_documents_are_found(spark):
    """Held-out good documents with a run of lines of a poor one at a known place.

    A run's lines that stand in good documents too (stock passages, licence lines) have no known mark
    and are not counted.
    """
    sf = f"{TESTDATA}/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    crf = line_crf.fit(docs, labels.where("doc_id % 2 = 0"))
    assert crf.follow[0, 0] > crf.follow[0, 1] and crf.follow[1, 1] > crf.follow[1, 0]
    rows = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").orderBy("doc_id").collect()
    kinds = {q: [r.text.split("\n") for r in rows if r.quality == q] for q in (0, 1)}
    stock = {line for lines in kinds[1] for line in lines}
    marks, truth, changing = [], [], 0
    rng = np.random.default_rng(3)
    for poor in kinds[0]:
        good = kinds[1][rng.integers(len(kinds[1]))]
        run, at = poor[: 1 + rng.integers(8)], rng.integers(len(good) + 1)
        lines = [(line, 0) for line in good[:at]] + [(line, -1 if line in stock else 1) for line in run] + [(line, 0) for line in good[at:]]
        lines = [(line, mark) for line, mark in lines if line.split()]
        features, _ = line_crf.cut_lines("\n".join(line for line, _ in lines).encode())
        found = crf.decode(features)
        changing += len(set(found)) == 2
        marks.extend(found)
        truth.extend(mark for _, mark in lines)
    marks, truth = np.array(marks), np.array(truth)
    marks, truth = marks[truth >= 0], truth[truth >= 0]
    hits = (marks & truth).sum()
    assert hits >= 0.9 * marks.sum() and hits >= 0.9 * truth.sum(), (hits, marks.sum(), truth.sum())
    assert changing >= 0.8 * len(kinds[0]), (changing, len(kinds[0]))


# -- 2 ----------------------------------------------------------------------------------------
def plain_repeats(texts, size):
    """(n_bytes, n_removed, n_spans, kept_sha256) per text, by counting every string."""
    data = [t.encode() for t in texts]
    counts = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if counts[d[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice([b"a", b"\0", b"\0a", b"ab", b"abcdefgh"])
        x = bytes(rng.choice(letters) for _ in range(rng.choice([1, 2, 9, 30, 300])))
        x = x + x[: len(x) // 2] + x if rng.random() < 0.5 else x
        words = suffix_dedup._first_words(np.frombuffer(x + bytes(8), np.uint8))
        order = suffix_dedup.suffix_array(words)
        assert order.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        for depth in (20, 400):
            shared = [0]
            for a, b in zip(order, order[1:]):
                pairs = zip(x[a:], x[b:])
                shared.append(min(depth, sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], pairs))))
            assert suffix_dedup.common_prefixes(words, order, depth).tolist() == shared


def test_repeated_bytes_on_the_test_table(spark, texts):
    found = collected(queries.op2_suffix_dedup(spark, SF))
    for doc_id, expected in zip(texts, plain_repeats(texts.values(), 400)):
        assert tuple(found[doc_id])[1:] == expected


@pytest.mark.parametrize("most", [2, 8192])
def test_repeated_bytes_hot_and_cold(spark, most):
    """A passage that most texts share, in whole and in part, and periodic texts."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefghé ") for _ in range(70))
    texts = ["ab" * 40, "ab" * 25, "x" * 90, "x" * 31, passage, None, "", "short"]
    for i in range(60):
        own = ["".join(rng.choice("klmnopß") for _ in range(rng.randrange(40))) for _ in "12"]
        cut = passage[rng.randrange(30) : 70 - rng.randrange(30)]
        texts.append(own[0] + cut + own[1])
    texts += texts[10:14]
    docs = spark.createDataFrame([(i % 66, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = suffix_dedup.repeated_bytes(docs, size=32, anchor=16, most=most)
    expected = plain_repeats([t or "" for t in texts], 32)
    assert as_written(found) == sorted(((i % 66, *e) for i, e in enumerate(expected)), key=repr)


def test_a_window_of_many_stretches_is_sent_once_per_shard(spark):
    rng = random.Random(4)
    own = lambda: bytes(rng.choice(b"klmnop") for _ in range(20))
    shared = bytes(range(100, 132))
    stretches = [own() + shared + own() for _ in range(300)]
    rows = [(7, i % 4, str(i).encode(), x, 1, 4) for i, x in enumerate(stretches)]
    schema = "key long, shard long, digest binary, stretch binary, n long, ranges long"
    cut = spark.createDataFrame(rows, schema)
    slices = suffix_dedup._shard_windows(cut, 32).collect()
    sent = Counter(w for r in slices for w in zip(r.high, r.low))
    windows = {x[i : i + 32] for x in stretches for i in range(len(x) - 31)}
    assert len(sent) == len(windows) and max(sent.values()) == 4
    many = [w for r in slices for w, m in zip(zip(r.high, r.low), r.many) if m]
    assert many.count(sent.most_common(1)[0][0]) == 4


def test_long_periodic_texts_are_split_by_bytes(spark):
    """Few stretches, but long ones: the shards of their keys follow their bytes."""
    texts = ["ab" * n for n in (400, 700, 900, 1000)] + ["=" * n for n in (300, 800, 801)] + ["x" + "yz" * 30]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for key_bytes in (500, 1 << 20):
        found = suffix_dedup.repeated_bytes(docs, size=32, anchor=16, key_bytes=key_bytes)
        got = [tuple(r)[1:] for r in sorted(found.collect(), key=lambda r: r.doc_id)]
        assert got == plain_repeats(texts, 32)


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_edges_of_a_hot_node_are_split(spark):
    """The node of a star that has a third of all edges, in the join beside a written table."""
    edges = spark.range(1, 60_000).selectExpr("if(id % 3 = 0, 0, id - 1) AS u", "id AS v").repartition(8)
    for name, value in SKEWED.items():
        spark.conf.set(name, value)
    try:
        query = components_module._with_least(edges)._jdf.queryExecution()
        query.executedPlan().executeCollect()
        assert "skew=true" in query.executedPlan().toString()
    finally:
        for name in SKEWED:
            spark.conf.unset(name)


def test_rows_of_a_large_text_meet_their_winner_in_many_tasks(spark):
    n = 100_000
    docs = spark.range(n).selectExpr("id AS doc_id", "if(id % 3 = 0, 'copy', 'own ' || id) AS text")
    best = exact_dedup.winners(docs, "doc_id", "text", 64)
    rows = exact_dedup._keyed(docs, "doc_id", "text").select(*exact_dedup.KEY, "id")
    dealt, winners = exact_dedup._salted(rows, best, 64)
    largest = dealt.groupBy(*exact_dedup.KEY, "salt").count().agg({"count": "max"}).first()[0]
    assert largest < 0.05 * n
    assert winners.count() == best.count() + 63
    groups = exact_dedup.exact_groups(docs).where("group_size > 1").collect()
    assert len(groups) == 33_334 and {r.keep_id for r in groups} == {99_999}
    assert [r.doc_id for r in groups if r.kept] == [99_999]


def test_repeated_bytes_of_odd_rows(spark, odd, nothing):
    expected = plain_repeats([r[1] or "" for r in ODD], 400)
    got = as_written(suffix_dedup.repeated_bytes(odd))
    assert got == sorted(((r[0], *e) for r, e in zip(ODD, expected)), key=repr)
    assert suffix_dedup.repeated_bytes(nothing).count() == 0
    cleaned = suffix_dedup.without_repeats(odd)
    assert cleaned.columns == odd.columns
    assert cleaned.where("doc_id = 3").count() == 2
    assert suffix_dedup.without_repeats(nothing).count() == 0


# -- 3 ----------------------------------------------------------------------------------------
def plain_verdict(url, rules, words):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [
        (len(h) + len(p), len(h), h + p, says)
        for h, p, says in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, *max(fits)[2:]
    listed = any(w in re.split(r"[.-]", host) for w in words)
    return host, path, None, "block" if listed else "allow"


URLS = [
    None, "", "example.org/es/", "http://example.org", "HTTP://A.EXAMPLE.ORG/en/1?x", "x://org/",
    "http://notexample.org/es/", "http://example.org/es", "https://m.example.com/de/1#://y/",
    "http://spam.example.net/a", "http://spammy.net/", "http://a-bets.b.net?x/y", "://com/fr/",
    "http://b.com/fr/" + "x" * 50_000, "http://" + "a." * 500 + "org/", "http://x.org\n/es/ a",
]


@pytest.mark.parametrize("max_bytes", [8 << 20, 40])
def test_url_verdicts(spark, max_bytes):
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    hosts = pages.select(url_filter.host_of("url").alias("host")).distinct()
    listed = hosts.where(hosts["host"].rlike(queries.HOST_PATTERN))
    found = collected(url_filter.judge_urls(pages, queries.URL_RULES, listed, max_bytes=max_bytes), "page_id")
    for i, url, *_ in rows:
        assert tuple(found[i])[1:] == plain_verdict(url, queries.URL_RULES, queries.HOST_WORDS)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(empty, queries.URL_RULES, listed).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 37 == 0).alias("listed")
    )
    levels = url_filter.cascade(keys)
    assert len(levels) > 2
    wrong = keys.where(url_filter.listed(F.col("key"), levels) != F.col("listed"))
    assert wrong.count() == 0


@pytest.mark.parametrize("max_bytes", [8 << 20, 300])
def test_cascades_by_shard_answer_alike(spark, max_bytes):
    """Rows of one key that fill half of the table, rows that repeat, and keys listed and not."""
    from pyspark.sql import functions as F

    keys = spark.range(3000).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 7 == 0).alias("listed")
    )
    hot = spark.range(4000).select(F.lit("k14").alias("key"), F.lit(True).alias("right"), "id")
    rows = keys.select("key", F.col("listed").alias("right"), F.lit(0).cast("long").alias("id"))
    rows = rows.union(rows.limit(10)).union(hot)
    found = url_filter.with_listed(rows, "key", keys, max_bytes)
    assert found.columns == ["key", "right", "id", "_listed"]
    assert found.count() == 7010
    assert found.where("_listed IS DISTINCT FROM right").count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Join" not in plan
    none = url_filter.with_listed(rows, "key", keys.select("key", F.lit(False).alias("listed")), max_bytes)
    assert none.where("_listed").count() == 0
    with pytest.raises(ValueError):
        url_filter.with_listed(rows, "key", keys, 1)


# -- 4 ----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def bpe_row(encoding, text):
    ids = encoding.encode_ordinary(text)
    printed = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(printed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_byte_bpe(spark, texts, odd, nothing, tiktoken_encoding):
    found = collected(queries.op4_byte_bpe(spark, SF))
    for doc_id, text in texts.items():
        assert tuple(found[doc_id])[1:] == bpe_row(tiktoken_encoding, text)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_documents(odd, path, public_tokenizers.PATTERN)
    got = as_written(encoded.drop("ids"))
    expected = [(r[0], *bpe_row(tiktoken_encoding, r[1] or "")) for r in ODD]
    assert got == sorted(expected, key=repr)
    assert byte_bpe.encode_documents(nothing, path, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_random_texts(tiktoken_encoding):
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(4)
    for k in range(150):
        size = rng.choice([0, 1, 5, 100, 1500])
        text = "".join(rng.choice("ab cdeßé日本½² \n\t's1234ththhere\x85\xa0") for _ in range(size))
        text = text if k % 2 else re.sub(r"\s", "", text)
        (ids,) = bpe.encode([text])
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


# -- 5 ----------------------------------------------------------------------------------------
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def classes_of(items, linked):
    """Least member reachable, by repeated relabelling."""
    label = {x: x for x in items}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_join(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abé𝔘 ") for _ in range(rng.randrange(8, 16))) for _ in range(12)]
    lines = set(base)
    for line in base:
        for _ in range(8):
            new = list(line)
            for _ in range(rng.randrange(1, 5)):
                at = rng.randrange(len(new))
                new[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "é"])
            if len(new) >= 8:
                lines.add("".join(new))
    lines = sorted(x for x in lines if len(x) >= 8)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    cut = line_dedup.lines_of(docs, "doc_id", "text", 8)
    names = {tuple(r["id"]): r["line"] for r in cut.collect()}
    pairs = line_dedup.close_pairs(cut, edits).collect()
    found = {frozenset((names[tuple(r.a)], names[tuple(r.b)])) for r in pairs}
    expected = {
        frozenset(p) for p in itertools.combinations(lines, 2) if distance(*p) <= edits
    }
    assert found == expected
    kept = collected(line_dedup.dedup_lines(docs, edits=edits, least_chars=8))
    label = classes_of(range(len(lines)), [tuple(lines.index(x) for x in p) for p in expected])
    for i in range(len(lines)):
        assert kept[i].n_removed == (label[i] != i)


def test_line_dedup_of_odd_rows(spark, odd, nothing):
    found = line_dedup.dedup_lines(odd)
    assert found.count() == len(ODD)
    assert [r.n_lines for r in found.where("doc_id = 1").collect()] == [0]
    assert line_dedup.dedup_lines(nothing).count() == 0
    long = "this line stands here twice, word for word"
    rows = [(2, f"{long}\n\nshort\n{long}"), (1, f"short\n{long}!"), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (2, 0), 2: (4, 2), None: (1, 1)}


def test_equal_short_lines_are_removed_by_the_query(spark, tmp_path):
    rows = [(2, "one\ntwo\n\none\n \t"), (1, "two\n\n \t\nTwo"), (3, "日本\ntwo!"), (4, "日本"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = collected(queries.op5_line_dedup(spark, str(tmp_path)))
    assert {i: r.n_removed for i, r in found.items()} == {1: 0, 2: 2, 3: 0, 4: 1, 5: 0}
    assert len(found[2].class_ids) == 2


# -- 6 ----------------------------------------------------------------------------------------
def test_co_training_on_held_out_documents(spark):
    sf = f"{TESTDATA}/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    even = labels.where("doc_id % 2 = 0")
    found = collected(co_training.classify(docs, even))
    assert len(found) == docs.count()
    held = labels.where("doc_id % 2 = 1").collect()
    good = [found[r.doc_id] for r in held if r.quality == 1]
    poor = [found[r.doc_id] for r in held if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in poor) >= 0.9 * len(poor)


def plain_co_training(text, meta, y, pool_text, pool_meta, mean, scale, rounds, share, confident):
    """The same exchange with all rows in memory, taught row by row; raw scores of the pool."""
    held = np.arange(len(y)) % 3 == 0
    ones = lambda cells: np.eye(co_training.META_FEATURES)[cells].sum(axis=1)
    data = [((text - mean) / scale, (pool_text - mean) / scale, 1.0), (ones(meta), ones(pool_meta), 5.0)]
    label, weight = np.full((2, len(pool_text)), -1), np.zeros((2, len(pool_text)))  # by the view that taught
    for number in range(rounds + 1):
        raws, odds = [], []
        for v, (x, pool, ridge) in enumerate(data):
            new = label[1 - v] >= 0
            w = co_training.logistic(
                np.concatenate((x[~held], pool[new])), np.concatenate((y[~held], label[1 - v][new])),
                np.concatenate((np.ones((~held).sum()), weight[1 - v][new])), ridge,
            )
            raw = lambda m: np.clip(m @ w[:-1] + w[-1], -12, 12)  # noqa: B023, E731
            slope, shift = co_training.logistic(raw(x[held])[:, None], y[held], np.ones(held.sum()), 0.1)
            raws.append(raw(pool))
            odds.append(max(0.0, slope) * raws[-1] + shift)
        if number == rounds or not len(pool_text):
            return raws
        for v in (0, 1):
            for mark, sign in ((1, 1), (0, -1)):
                sure = (label[v] < 0) & (sign * odds[v] > np.log(confident / (1 - confident)))
                quota = np.ceil(share * (y.mean() if mark else 1 - y.mean()) * len(pool_text))
                bins = sign * np.minimum(np.floor((raws[v] + 12) / 24 * 1024), 1023)
                chosen = sure & False
                for at in sorted(set(bins[sure]), reverse=True):
                    if chosen.sum() < quota:
                        chosen |= sure & (bins == at)
                label[v][chosen] = mark
                weight[v][chosen] = 0.5 * (~held).sum() / len(pool_text) * min(1, quota / max(1, chosen.sum()))


@pytest.mark.parametrize("size", [0, 2000])
def test_views_teach_each_other(spark, size):
    """Few labels on a view that needs more; the other view is sure of the pool."""
    rng = np.random.default_rng(5)
    y = np.tile([0, 0, 0, 1, 1, 1], 6)
    pool_y, test_y = rng.integers(0, 2, size), rng.integers(0, 2, 4000)
    base = np.array([0, co_training.LANGS, co_training.LANGS + co_training.SOURCES])

    def strong(labels):
        cells = rng.integers(0, 16, (len(labels), 3))
        cells[:, 1] = 2 * labels + rng.integers(0, 2, len(labels))
        return cells + base

    weak = lambda labels: (labels * 2.0 - 1)[:, None] * 0.3 + rng.normal(size=(len(labels), 20))
    text, meta, pool_text, pool_meta = weak(y), strong(y), weak(pool_y), strong(pool_y)
    rows = list(zip(pool_text.tolist(), pool_meta.tolist()))
    pool = spark.createDataFrame(rows, "text array<double>, meta array<int>").repartition(3)
    mean, scale = np.full(20, 0.1), np.full(20, 1.1)
    test_text, right = weak(test_y), {}
    for rounds in (0, 3):
        model = co_training.co_train(text, meta, y, pool, mean, scale, rounds, 0.1, 0.7)
        right[rounds] = ((model.text.raw(test_text) > 0) == test_y).mean()
        plain = plain_co_training(text, meta, y, pool_text, pool_meta, mean, scale, rounds, 0.1, 0.7)
        assert np.allclose(model.text.raw(pool_text), plain[0], atol=1e-4)
        assert np.allclose(model.meta.raw(pool_meta), plain[1], atol=1e-4)
    assert (right[3] > right[0] + 0.03) == (size > 0)


def test_co_training_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(3, 1), (None, 0), (4, None)], "doc_id long, quality long")
    found = co_training.classify(odd, labels)
    assert found.count() == len(ODD)
    assert found.where("NOT kept").count() == 0  # no poor label, nothing to reject by
    assert co_training.keep_good(odd, labels).columns == odd.columns
    assert co_training.classify(nothing, labels.limit(0)).count() == 0


# -- 7 ----------------------------------------------------------------------------------------
def plain_fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_simhash(spark, texts, odd, nothing):
    found = collected(queries.op7_simhash_near(spark, SF))
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    links = [p for p in itertools.combinations(texts, 2) if (prints[p[0]] ^ prints[p[1]]).bit_count() <= 3]
    label = classes_of(texts, links)
    for doc_id in texts:
        assert tuple(found[doc_id])[1:] == (f"{prints[doc_id]:016x}", label[doc_id])
    rows = simhash_near.near_groups(odd).collect()
    got = sorted((str(r.doc_id), r.fingerprint) for r in rows)
    assert got == sorted((str(r[0]), f"{plain_fingerprint(r[1] or ''):016x}") for r in ODD)
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 3}
    assert simhash_near.near_groups(nothing).count() == 0
    kept = simhash_near.drop_near(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 3 in ids and 4 not in ids


def test_one_row_of_each_near_group_stays(spark):
    one, two, three = ("alpha beta gamma delta", "red green blue black", "north east south west")
    rows = [
        (None, one, "a"), (None, one, "b"), (None, two, "a"),
        (8, three, "a"), (8, "some other text here", "a"), (9, three, None), (None, three, "a"),
        (7, "x", None), (7, None, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = simhash_near.drop_near(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    expected = [(None, one), (None, two), (8, three), (8, "some other text here"), (7, "x"), (7, None)]
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_hamming_links(spark, bits):
    rng = random.Random(bits)
    values = set()
    for _ in range(15):
        seed = rng.getrandbits(64)
        for _ in range(12):
            v = seed
            for _ in range(rng.randrange(8)):
                v ^= 1 << rng.randrange(64)
            values.add(v - (1 << 64) if v >> 63 else v)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {(r.a, r.b) for r in simhash_near.links(fps, bits).collect()}
    mask = (1 << 64) - 1
    pairs = itertools.combinations(sorted(values), 2)
    assert found == {p for p in pairs if ((p[0] ^ p[1]) & mask).bit_count() <= bits}


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    pairs += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    links = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(links, "a", "b").collect()}
    label = classes_of({x for p in pairs for x in p}, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert found == {x: label[x] for x in linked}


# -- 8 ----------------------------------------------------------------------------------------
def test_exact_groups(spark, odd, nothing):
    got = as_written(exact_dedup.exact_groups(odd, salts=3))
    groups = defaultdict(list)
    for row in ODD:
        groups[(row[1] or "").translate(LOWER)].append(row[0])
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            expected.append((i, keep, len(ids), kept, digest))
    assert got == sorted(expected, key=repr)
    assert exact_dedup.exact_groups(nothing).count() == 0
    kept = exact_dedup.drop_exact(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expected if e[3])


# -- 9 ----------------------------------------------------------------------------------------
def test_main_text_of_written_pages():
    page = (
        "<head><title>no</title></head><body><div class='cookie-notice'>no</div><nav>no</nav>"
        "<article><header><h1>T &amp; t</h1></header><p>a<b>b</b> c<p>d<ul><li>1<li>2</ul>"
        "<div class=comments><p>no</div><aside>no</aside><script>var a='</p>'</script>"
        "e\n\n  &eacute;&nbsp;z 1 < 2</article><p>no</p><footer>no</footer>"
    )
    assert style_tree.page_text(page, frozenset()) == "T & t ab c d 1 2 e é z 1 < 2"
    assert style_tree.page_text("<p>x<div hidden>no</div><!-- no --><p>y<br>z", frozenset()) == "x y z"
    for broken in ("", "<", "<p", "</", "<!--", "<script>", "a<article><p>b", "</div></p>", "&am"):
        style_tree.page_text(broken, frozenset())
    assert style_tree.page_text("<div>" * 3000 + "deep", frozenset()) == "deep"


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<p>a<svg class='i'/>b</p><p>c", "ab c"),
        ("<p>a <svg><style/><path d='M0'/><g><text>no</text></g></svg> b</p><p>c", "a b c"),
        ("<div><p>a<svg viewBox='0'><path d='M0'></p><p>b</div><p>c", "a b c"),
        ("<svg><g>no<p>a<p>b", "a b"),
        ("<svg><foreignObject><div>no</div></foreignObject></svg>a", "a"),
        ("<title-card>a</title-card><style-guide>b<p>c</style-guide><template-part>d", "a b c d"),
        ("<div>a<iframe src=x></div>b<p>c<noscript><div>no</div></noscript>d</p>e", "a b cd e"),
        ("a<iframe src='x'/><p>b<iframe>no</iframe>c<template><p>d", "a bc d"),
        ("<title>no</title><p>a<template><p>no</template>b<script>no", "ab"),
    ],
)
def test_main_text_around_elements_that_are_apart(page, expected):
    assert style_tree.page_text(page, frozenset()) == expected


def test_articles_of_the_test_pages(spark):
    import html as h

    pages = collected(spark.read.parquet(f"{SF}/pages.parquet"), "page_id")
    found = collected(queries.op9_style_tree(spark, SF), "page_id")
    assert len(found) == len(pages)
    for page_id, page in pages.items():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page.html, re.S)[1]
        spaced = re.sub(r"</?(p|br|h1)[^>]*>", " ", re.sub(r"</?b>", "", inside))
        assert found[page_id].text == " ".join(h.unescape(spaced).split())
        assert found[page_id].n_chars == len(found[page_id].text)


def test_importance_is_that_of_plain_entropies(spark):
    rng = np.random.default_rng(9)
    entries = [
        ("h", int(p), int(p) // 3, kind, int(v))
        for p in range(1, 9) for kind in ("content", "style") for v in rng.integers(0, 1 + p, 12)
    ]
    schema = "host string, path long, above long, guard int, kind string, value long"
    frame = spark.createDataFrame([(h, p, a, style_tree.FREE, k, v) for h, p, a, k, v in entries], schema)
    counts = frame.groupBy(*style_tree.NODE, "kind", "value").agg({"guard": "max", "*": "count"})
    counts = counts.withColumnsRenamed({"max(guard)": "guard", "count(1)": "n"}).selectExpr("*", "1 AS chars")
    importance = defaultdict(float)
    for p in range(1, 9):
        for kind, weight in (("content", 0.9), ("style", 0.1)):
            n = np.array(list(Counter(v for _, q, _, k, v in entries if (q, k) == (p, kind)).values()))
            importance[p] += weight * -(n / 12 * np.log(n / 12)).sum() / np.log(12)
    for least in (0.3, 0.5, 0.7):
        expected = {p for p in range(1, 9) if importance[p] < least and importance.get(p // 3, 0) >= 0.5}
        cut = [set(r.cut) for r in style_tree.unimportant(counts, least, 8).collect()]
        assert cut == ([expected] if expected else [])


def test_branches_that_all_pages_share_are_cut(spark):
    rows = [
        (i, "http://a.org/x", f"<article><p>text {i} here<p>more {i}<div class=x>Same <b>on</b> all</div></article>")
        for i in range(12)
    ]
    rows += [(100 + i, "http://b.org/x", "<article><p>one article, copied</article>") for i in range(12)]
    rows += [(200, None, None), (201, "http://c.org", ""), (201, "http://c.org", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = style_tree.main_text(pages).collect()
    assert len(found) == len(rows)
    text = {r.page_id: r.text for r in found}
    assert text[3] == "text 3 here more 3"
    assert text[105] == "one article, copied"
    assert text[200] == text[201] == ""
    assert style_tree.main_text(pages.limit(0)).count() == 0


def test_menus_that_take_turns_are_cut_without_their_names(spark):
    """Blocks without any declared name; the article is the branch with most text, also if many are copies."""
    page = "<body><div class=a>menu {} of some</div><div class=b>{}</div><div class=c>notice {}</div></body>"
    rows = [(i, "http://a.org/x", page.format(i % 20, f"article {i} " * 9, i % 9)) for i in range(400)]
    copied = lambda i: f"article {i % 2 * i} " * 9
    rows += [(1000 + i, "http://b.org/x", page.format(i, copied(i), i)) for i in range(40)]
    rows += [(2000 + i, "http://c.org/x", page.format(i % 2, f"article {i} " * 9, i % 2)) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in style_tree.main_text(pages).collect()}
    for i in range(400):
        assert text[i] == (f"article {i} " * 9).strip()
    for i in range(40):
        assert text[1000 + i] == f"menu {i} of some {copied(i)}notice {i}"
    assert text[2003] == "menu 1 of some " + "article 3 " * 9 + "notice 1"  # too few pages to tell


def test_large_hosts_of_the_test_pages_without_declared_noise(spark):
    """Where one host has hundreds of pages, the trees alone find what the elements declare."""
    from pyspark.sql import functions as F

    html = F.col("html")
    for old, new in (("nav", "a"), ("footer", "b"), ("article", "c")):
        html = F.replace(html, F.lit(f"<{old}>"), F.lit(f"<div class={new}>"))
        html = F.replace(html, F.lit(f"</{old}>"), F.lit("</div>"))
    html = F.replace(html, F.lit('class="ad"'), F.lit("class=d"))
    pages = spark.read.parquet(f"{TESTDATA}/sf0.1/pages.parquet")
    host = url_filter.host_of("url")
    large = pages.groupBy(host.alias("host")).count().where("count >= 300").select("host")
    pages = pages.withColumn("host", host).join(large, "host", "left_semi")
    right = collected(style_tree.main_text(pages), "page_id")
    found = collected(style_tree.main_text(pages.withColumn("html", html)), "page_id")
    assert len(found) >= 300
    assert all(found[i].text == right[i].text for i in right)


@pytest.mark.parametrize("n", [10, 10_000])
def test_what_repeats_in_articles_is_kept_on_hosts_of_any_size(spark, n):
    page = "<article><h2>Part {}</h2><p>text {} <b>bold</b> here</p><div class=x>{}</div></article>"
    last = {1: "own end of one page"}
    rows = [(i, "http://a.org/x", page.format(i % 2, i, last.get(i, "Same on all"))) for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in style_tree.main_text(pages).collect()}
    for i in range(n):
        assert text[i] == f"Part {i % 2} text {i} bold here" + (f" {last[i]}" if i in last else "")


# -- 10 ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("name, by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_tokens_are_those_of_the_file(texts, name, by_words):
    import pyarrow as pa

    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path(name)
    plain = tokenizers.Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    sample = [*list(texts.values())[:200], "", " \n\t", "It's 2024!! e\u0301 \u00c9COLE", "a  b\u00a0c"]
    tokens = packing.WordTokens(path)
    assert tokens.by_words == by_words
    found = tokens.encode(pa.array(sample, pa.string()))
    assert [ids.tolist() for ids in found] == [plain.encode(t, add_special_tokens=False).ids for t in sample]


def check_packing(rows, texts, size):
    """Every id in one piece, sequences gapless and not too long; returns the padding's share."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return 1 - sum(r.length for r in rows) / (size * len(sequences))


def test_packing(spark, texts, odd, nothing):
    padding = check_packing(queries.op10_packing(spark, SF).collect(), texts, 4096)
    assert padding < 0.03
    path = public_tokenizers.path("word_bpe_49k.json")
    unique = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(unique, path, size=64, unit=4).collect()
    check_packing(rows, {r[0]: r[1] or "" for r in ODD if r[0] is not None}, 64)
    assert packing.pack(odd, path).where("start = 0").count() == len(ODD)
    assert packing.pack(nothing, path).count() == 0


def test_knapsack_and_patterns():
    rng = random.Random(7)
    for _ in range(30):
        weights = np.array(sorted(rng.sample(range(1, 13), 4)))
        prices = np.array([rng.random() for _ in weights])
        value, pattern = packing.best_pattern(prices, weights, 12)
        ranges = (range(12 // w + 1) for w in weights)
        fits = (p for p in itertools.product(*ranges) if np.dot(p, weights) <= 12)
        assert abs(value - max(np.dot(p, prices) for p in fits)) < 1e-9
        assert pattern @ weights <= 12 and abs(pattern @ prices - value) < 1e-9
    counts = {w: rng.randrange(1, 400) for w in range(1, 65)}
    found = packing.patterns(counts, 64)
    packed = Counter()
    for pattern, times in found:
        assert sum(w * n for w, n in pattern.items()) <= 64
        for w, n in pattern.items():
            packed[w] += n * times
    assert packed == counts
    weights, demand = (np.array(x) for x in zip(*sorted(counts.items())))
    _, used = packing.relaxed(weights, demand.astype(float), 64)
    assert sum(times for _, times in found) <= used.sum() + len(counts) / 2
