"""The prefix trie, chat formatting and the filter audit against plain versions of their contracts."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from stayrate.llm import chat_format, filter_audit, prefix_trie, queries

SF = f"{TESTDATA}/sf0.001"
CONV = "conv_id long, turn long, role string, text string"
EXTRA = ", id string, digest string, depth string, band string, n long, place long, piece string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(rows):
    """id -> [(role, text)] as the contracts order and read them."""
    def key(r):
        role, text = r[2] or "", r[3] or ""
        said = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        return (r[1] is not None, r[1] or 0, said)

    out = defaultdict(list)
    for r in sorted(rows, key=key):
        if r[0] is not None:
            out[r[0]].append((r[2] or "", r[3] or ""))
    return dict(out)


# -- 11 ---------------------------------------------------------------------------------------
def plain_trie(rows, rebranch=True):
    original = conversations(rows)
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + own[h:] if rebranch else own
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        size = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += size
    return sorted(
        (
            who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(children[node]),
            leaves[node], saved[node],
            sha(",".join(str(c) for c in who if len(rebuilt[c]) == len(node))),
        )
        for node, who in members.items()
    ) if rebuilt else []


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    return sorted(tuple(r) for r in df.select(*NODE).collect())


def test_trie_of_the_test_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(queries.op11_prefix_trie(spark, SF)) == plain_trie(rows)


def test_trie_of_odd_conversations(spark):
    rng = random.Random(3)
    rows = [
        (None, 0, "user", "lost"), (-7, 1, None, None), (-7, None, "user", "first"), (-10, 0, "user", "é"),
        (3, 2, "user", "twice"), (3, 2, "user", "twice"), (3, 2, "system", "tie"), (3, None, None, None),
    ]
    for c in range(20, 70):  # few texts, so that prefixes are shared at every depth
        rows += [(c, t, rng.choice("ua"), rng.choice(["", "x", "日本"])) for t in range(rng.randrange(1, 12))]
    rows += [(100 + i, t, "user", "copy") for i in range(40) for t in range(9)]
    df = spark.createDataFrame([(*r, *"xxxx", 1, 2, "x") for r in rows], CONV + EXTRA)
    assert nodes(prefix_trie.conversation_trie(df)) == plain_trie(rows)
    assert nodes(prefix_trie.conversation_trie(df.limit(0))) == []


def test_trie_of_long_conversations(spark):
    """Several bands: shared, left, and ended before, at and behind the border of a band."""
    band = prefix_trie.BAND
    lengths = {0: 2 * band + 40, 1: band, 2: band + 1, 3: band - 1, 5: 2 * band, 6: 2 * band + 40, 7: 3 * band}
    other = {2: band, 3: 5, 6: band + 3, 7: 2 * band}  # from this turn on the texts are others
    rows = [
        (c, t, "user", f"t{t}" if t < other.get(c, 10**9) else f"t{t} of {c}")
        for c, n in lengths.items() for t in range(n)
    ]
    turns = prefix_trie.numbered(spark.createDataFrame(rows, CONV)).withColumnRenamed("place", "depth")
    convs = turns.groupBy("id").agg(F.count("*").alias("n"))
    assert nodes(prefix_trie.trie_nodes(turns, convs)) == plain_trie(rows, rebranch=False)


def as_path(symbols):
    total, digests = 0, [bytes(16)]
    for i, s in enumerate(symbols):
        total += int.from_bytes(hashlib.md5(f"{i} {s}".encode()).digest(), "big")
        digests.append((total % 2**128).to_bytes(16, "big"))
    return prefix_trie.Path(0, len(symbols), b"".join(digests), np.arange(len(symbols) + 1))


def test_fat_binary_search_finds_the_longest_shared_prefix():
    rng = random.Random(5)
    trie, seen = prefix_trie.ZFastTrie(1), []

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    trie.handles = Counted()
    for ident in range(600):
        base = rng.choice(seen)[: rng.randrange(60)] if seen and rng.random() < 0.7 else ""
        word = base + "".join(rng.choice("ab") for _ in range(rng.randrange(40)))
        path, Counted.asked = as_path(word), 0
        shared = trie.locate(path)[2]
        assert Counted.asked <= max(1, len(word)).bit_length()
        common = (len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(word, s)))) for s in seen)
        assert shared == max(common, default=0)
        trie.insert(path, ident, (1,), 1)
        seen.append(word)
    for node in range(1, len(trie.up)):
        top, end = trie.top[node], trie.end[node]
        handle = prefix_trie.two_fattest(top, end)
        assert handle == max(range(top + 1, end + 1), key=lambda d: d & -d)
        assert trie.handles[trie.path[node].at(handle)] == node
    digests, least, _, _, sums, here = trie.expanded()
    plain = defaultdict(list)
    for ident, word in enumerate(seen):
        for d in range(len(word) + 1):
            plain[as_path(word[:d]).at(d)].append((ident, d == len(word)))
    assert len(digests) == len(plain)
    for digest, first, n, ends in zip(digests, least, sums[:, 0], here):
        assert (first, n, ends) == (plain[digest][0][0], len(plain[digest]), sum(e for _, e in plain[digest]))


# -- 12 ---------------------------------------------------------------------------------------
HOSTILE = [
    "", "plain", "</s>", "<s></s>[INST][/INST]", "\\", "\\1", "\\0</s>", "<", "[", "</", "</s", "<<s>>", "[[INST]]",
    "<image>", "<<image>audio>", "\\\\[INST]\\", "é日本\n\t", "\\01\\12\\2",
]


def test_escapes_are_undone(spark):
    rng = random.Random(8)
    texts = HOSTILE + ["".join(rng.choice(HOSTILE) for _ in range(rng.randrange(6))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    control = re.compile(r"</?s>|\[/?INST\]|<image>|<audio>|<document>")
    hidden = chat_format.escape(F.col("t"))
    for text, shown, back in df.select("t", hidden, chat_format.unescape(hidden)).collect():
        assert back == text and not control.search(shown)


def digests(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for c, turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        learnt = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[c] = (len(turns), sha(whole), len(learnt), sha(learnt))
    return out


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_chat_reads_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    more = [(-7, 0, "user", queries.HOSTILE), (-7, 1, "assistant", queries.HOSTILE)]
    assert read(queries.op12_chat_format(spark, SF)) == digests(rows + more)


def test_chat_of_odd_conversations(spark):
    rng = random.Random(2)
    rows = [
        (None, 1, "assistant", "a"), (None, None, None, None), (1, None, "assistant", "null first"), (1, 0, "user", "x"),
        (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (3, 0, None, "[INST]"), (4, 1, "</s>", "\n"),
        (5, 0, "assistant", "word \\ </s> é" * 30_000), (6, 0, "assistant", None),
    ]
    rows += [(7 + i % 20, i, rng.choice(["assistant", "user", "[/INST]"]), rng.choice(HOSTILE)) for i in range(200)]
    df = spark.createDataFrame([(*r, *"xxxx", 1, 2, "x") for r in rows], CONV + EXTRA)
    assert read(chat_format.chat_digests(df)) == digests(rows)
    assert chat_format.chat_digests(df.limit(0)).count() == 0
    text = chat_format.formatted(df.withColumn("parts", chat_format.text_parts(F.col("text"))))
    one = {r.conv_id: r.formatted for r in text.where("conv_id IN (1, 3)").collect()}
    assert one == {
        1: "<s>[INST]assistant[/INST]null first</s>[INST]user[/INST]x</s>",
        3: "<s>[INST][/INST]\\2INST]</s>",
    }


def test_chat_with_attachments(spark):
    """Parts of every kind, documents with parts inside, in order, with positions and tokens."""
    def part(kind, text=None, ref=None, width=None, height=None, millis=None, pages=None, parts=None):
        return (kind, text, ref, width, height, millis, pages, parts)

    inner = [part("text", "page <image>")[:7], part("image", ref="fig", width=56, height=29)[:7], None]
    turns = [
        (1, 0, "user", [part("text", "see "), part("image", ref="a.png", width=280, height=28), part(None, " and "),
                        part("document", ref="b.pdf", pages=3, parts=inner), None]),
        (1, 1, "assistant", [part("text", "é "), part("audio", ref="c.ogg", millis=1001), part("text", "</s>")]),
        (2, 0, "assistant", None), (3, 0, "user", [part("image")]),
    ]
    schema = f"conv_id long, turn long, role string, parts array<struct<{chat_format.PART}>>"
    df = spark.createDataFrame(turns, schema)
    rows = {r.conv_id: r for r in chat_format.formatted(df).collect()}
    one = rows[1]
    assert one.formatted == (
        "<s>[INST]user[/INST]see <image> and <document>page \\1image><image></s>"
        "[INST]assistant[/INST]é <audio>\\1/s></s>"
    )
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [
        ("image", "a.png", 10), ("document", "b.pdf", 768), ("image", "fig", 4), ("audio", "c.ogg", 26)
    ]
    for a in one.attachments:
        assert one.formatted[a.start :].startswith(f"<{a.kind}>")
    assert [one.formatted[s.start :][: s.length] for s in one.loss] == ["é <audio>\\1/s>"]
    assert one.n_tokens_attached == 10 + 768 + 4 + 26
    assert rows[2].formatted == "<s>[INST]assistant[/INST]</s>" and rows[2].attachments == []
    assert [(a.kind, a.tokens) for a in rows[3].attachments] == [("image", 1)]
    read_back = chat_format.turns_of(F.col("formatted"))
    learnt = chat_format.learnt_text(F.col("formatted"), F.col("loss"))
    turns_read, said = chat_format.formatted(df).where("conv_id = 1").select(read_back, learnt).first()
    assert [(t.role, t.text, t.kinds) for t in turns_read] == [
        ("user", "see  and page <image>", ["image", "document", "image"]), ("assistant", "é </s>", ["audio"])
    ]
    assert said == "é </s>"
    bad = spark.createDataFrame([(1, 0, "user", [part("video")])], schema)
    with pytest.raises(Exception, match="no such kind"):
        chat_format.formatted(bad).collect()


def test_chat_stays_on_the_jvm(spark):
    plan = queries.op12_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "MapPartitions", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in plan
    assert plan.count("Exchange hashpartitioning") == 1


# -- 13 ---------------------------------------------------------------------------------------
WORD = re.compile("[^\x20\x09-\x0d]+")


def verdicts(rows):
    """Per row the set of failed filters."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        out.append({f for f, x in fails.items() if x})
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    by_part = defaultdict(list)
    for (i, _, part), fails in zip(rows, verdicts(rows)):
        by_part[part or ""].append((fails, i in good, i in toxic))
    out, shares = {}, defaultdict(int)
    for part, docs in by_part.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, start=1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                shares[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), failing - len(gone), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                )
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def test_audit_of_odd_documents(spark):
    rng = random.Random(4)
    good = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", good, good + " #", "A" * 300, "same " * 300, "\x0b\x0c\x85 \xa0x", good.upper(), "word $ " * 200, "É" * 50]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "a", "b"])) for _ in range(150)]
    rows += [(1000 + i, "hot copy " * 120, "hot") for i in range(80)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(50)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (1005, 1, 0)]
    extra = "row string, part string, digest string, filter string, n long, A string"
    docs = spark.createDataFrame([(*r, *"xxxx", 1, "x") for r in rows], f"doc_id long, text string, source string, {extra}")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(docs, known)) == plain_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), known).count() == 0
    assert audited(filter_audit.audit(docs, known.limit(0))) == plain_audit(rows, [])


def test_audit_of_other_filters(spark):
    """The operator itself takes any filters and losses."""
    rows = spark.range(40).select(F.col("id").alias("row"), F.lit("p").alias("part"))
    failing = {"x": rows.where("row % 2 = 0"), "y": rows.where("row % 3 = 0"), "z": rows.where("row < 0")}
    flags = {"lost": rows.where("row > 30")}
    found = {(r.filter_order, r.step): r for r in filter_audit.interactions(rows, failing, flags).collect()}
    assert len(found) == 18
    first, second, third = (found["xyz", s] for s in (1, 2, 3))
    assert (first.removed, first.kept, first.lost, first.unique_fails) == (20, 20, 4, 13)
    assert (second.removed, second.redundant, second.kept, second.lost) == (7, 7, 13, 2)
    assert (third.removed, third.kept, third.shapley) == (0, 13, 0)
    assert first.shapley == 3 * 20 + 3 * 13


def test_audit_shuffles_ids_before_the_prefixes(spark):
    rows = spark.range(40).select(F.col("id").alias("row"), F.lit("p").alias("part"))
    failing = {f: rows.where(f"row % {i} = 0") for i, f in enumerate("vwxyz", start=2)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = filter_audit.removals(failing, {})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows once, each filter's ids once, the counts once.
    assert plan.count("Exchange hashpartitioning") == 1 + 5 + 1
