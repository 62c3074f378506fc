"""Quality rules: word statistics and a linear-chain CRF over the lines of a text.

The CRF marks each line as content or boilerplate; Viterbi decoding finds the best sequence of
marks. A document that passes the base rules is kept if enough of its words stand in content lines.
The weights are trained on a bounded sample of labelled documents, cut into chains of lines: lines of
documents of poor quality count as boilerplate, others as content. As many chains again are spliced:
a run of lines of one kind stands at a known place among lines of the other, so marks change inside a
chain and the weights of neighbouring marks are learnt from changes too. The exact gradient of the
chains' likelihood (forward-backward) is followed for a fixed number of steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import SPACE, text_of
from stayrate.llm.training import labelled_sample

SYMBOLS = b"#*$%&|<>"
DIGITS, UPPER = b"0123456789", bytes(range(65, 91))
ENDS = (b".", b"!", b"?", b":", b'"')
CONTENT, BOILERPLATE = 0, 1
FEATURES = (
    "bias", "few words", "many words", "symbols", "digits", "capitals", "repeated words",
    "one word over and over", "sentence end", "words too short", "words too long", "bars",
    "stands again in the text", "short and stands again",
)
#: Lines per training sequence; longer documents give several.
CHAIN = 32


@dataclass(frozen=True)
class LineCrf:
    """Weights per feature and mark, of the first mark, and of neighbouring marks."""

    emit: np.ndarray
    first: np.ndarray
    follow: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best marks of a text's lines (Viterbi)."""
        scores = features @ self.emit
        best, back = self.first + scores[0], np.zeros((len(scores), 2), np.int8)
        (a, b), (c, d) = self.follow.tolist()
        x, y = best.tolist()
        for i, (s, t) in enumerate(scores[1:].tolist(), 1):
            from_x, from_y = x + a >= y + c, x + b >= y + d
            back[i] = (not from_x, not from_y)
            x, y = (x + a if from_x else y + c) + s, (x + b if from_y else y + d) + t
        marks = np.zeros(len(scores), np.int8)
        mark = int(y > x)
        for i in range(len(scores) - 1, -1, -1):
            marks[i] = mark
            mark = back[i, mark]
        return marks


NEUTRAL = LineCrf(np.zeros((len(FEATURES), 2)), np.zeros(2), np.zeros((2, 2)))


def line_features(line: bytes, words: list[bytes], again: bool) -> tuple[float, ...]:
    size, n = len(line), len(words)
    rare = len(set(words))
    top = max(map(words.count, set(words[:3]))) if n else 0
    mean = (size - n) / n
    return (
        1.0,
        float(n < 3),
        float(n > 30),
        min(1.0, 4 * (size - len(line.translate(None, SYMBOLS))) / size),
        (size - len(line.translate(None, DIGITS))) / size,
        (size - len(line.translate(None, UPPER))) / size,
        1 - rare / n,
        top / n if n > 3 else 0.0,
        float(line.rstrip().endswith(ENDS)),
        float(mean < 3),
        float(mean > 10),
        min(1.0, 8 * line.count(b"|") / size),
        float(again),
        float(again and n < 10),
    )


def cut_lines(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features and word counts of the lines that have words."""
    rows, counts = [], []
    lines = data.split(b"\n")
    times = Counter(lines)
    for line in lines:
        if words := line.split():
            rows.append(line_features(line, words, times[line] > 1))
            counts.append(len(words))
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(counts, np.int64)


# -- training ---------------------------------------------------------------------------------
def spliced(chains: list[np.ndarray], poor: list[bool]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every chain another one, into which a run of lines of the other kind is put, and its marks."""
    rng = np.random.default_rng(17)
    kinds = {kind: [c for c, p in zip(chains, poor) if p == kind] for kind in (False, True)}
    out, marks = [], []
    for chain, bad in zip(chains, poor):
        others = kinds[not bad]
        other = others[rng.integers(len(others))]
        start = rng.integers(len(other))
        run = other[start : start + rng.integers(1, CHAIN // 2 + 1)]
        at = rng.integers(len(chain) + 1)
        out.append(np.concatenate((chain[:at], run, chain[at:])))
        mark = np.full(len(out[-1]), int(bad))
        mark[at : at + len(run)] = int(not bad)
        marks.append(mark)
    return out, marks


def train(chains: list[np.ndarray], poor: list[bool], steps: int = 80, rate: float = 0.3) -> LineCrf:
    """Maximum likelihood by Adam on exact gradients; without both kinds of chains, NEUTRAL.

    Chains of content, chains of boilerplate and spliced ones weigh a third each.
    """
    if not any(poor) or all(poor):
        return NEUTRAL
    mixed, mixed_marks = spliced(chains, poor)
    group = np.concatenate((np.array(poor, int), np.full(len(mixed), 2)))
    marks = [np.full(len(c), int(p)) for c, p in zip(chains, poor)] + mixed_marks
    chains = chains + mixed
    longest = max(map(len, chains))
    x = np.zeros((len(chains), longest, len(FEATURES)))
    real = np.zeros((len(chains), longest), bool)
    y = np.zeros((len(chains), longest), int)
    for i, chain in enumerate(chains):
        x[i, : len(chain)] = chain
        real[i, : len(chain)] = True
        y[i, : len(chain)] = marks[i]
    weight = 1 / (3 * np.bincount(group)[group])
    model = [NEUTRAL.emit.copy(), NEUTRAL.first.copy(), NEUTRAL.follow.copy()]
    mean = [np.zeros_like(m) for m in model]
    square = [np.zeros_like(m) for m in model]
    for step in range(1, steps + 1):
        grads = _gradient(x, real, y, weight, *model)
        for m, g, a, b in zip(model, grads, mean, square):
            g = g - 1e-3 * m
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            m += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return LineCrf(*model)


def _gradient(x, real, y, weight, emit, first, follow) -> list[np.ndarray]:
    """Of the weighted log-likelihood when line t of chain i carries mark y[i, t]."""
    scores = x @ emit
    n, length, _ = x.shape
    forward, backward = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = first + scores[:, 0]
    for t in range(1, length):
        into = np.logaddexp.reduce(forward[:, t - 1, :, None] + follow, axis=1) + scores[:, t]
        forward[:, t] = np.where(real[:, t, None], into, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        out = follow + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        backward[:, t] = np.where(real[:, t + 1, None], np.logaddexp.reduce(out, axis=2), 0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    marginal = np.exp(forward + backward - total[:, None, None]) * real[..., None]
    gold = (y[..., None] == np.arange(2)) * real[..., None]
    excess = (gold - marginal) * weight[:, None, None]
    both = real[:, 1:]
    pair = np.exp(
        forward[:, :-1, :, None]
        + follow
        + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, None, None, None]
    )
    expected = (pair * (both * weight[:, None])[..., None, None]).sum(axis=(0, 1))
    pairs = (2 * y[:, :-1] + y[:, 1:])[both]
    weights = np.broadcast_to(weight[:, None], both.shape)[both]
    seen = np.bincount(pairs, weights, 4).reshape(2, 2)
    return [np.einsum("ntf,ntm->fm", x, excess), excess[:, 0].sum(axis=0), seen - expected]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 1500,
    chains: int = 6000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> LineCrf:
    """Train on at most ``chains`` chains of at most ``rows`` labelled documents (by hashes of id and
    place). Whole texts are cut by the executors; the driver sees the features of the chosen chains."""
    named = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    sample = labelled_sample(named, labels, "quality", rows, id_col, ["text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, y, text in zip(*(c.to_pylist() for c in batch.columns)):
                features, _ = cut_lines(text.encode("utf-8", "surrogatepass"))
                parts = [features[at : at + CHAIN].ravel() for at in range(0, len(features), CHAIN)]
                if parts:
                    arrays = [[doc] * len(parts), [y] * len(parts), range(len(parts)), parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, t) for a, t in zip(arrays, types)], names=["id", "y", "k", "chain"]
                    )

    types = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
    rows_of = sample.select(F.col("id").cast("string"), "y", "text")
    found = rows_of.mapInArrow(cut, "id string, y int, k long, chain array<double>")
    chosen = found.orderBy(F.xxhash64("id", "k"), "id", "k").limit(chains).collect()
    chosen.sort(key=lambda r: (r["id"], r["k"]))
    cut_chains = [np.array(r["chain"]).reshape(-1, len(FEATURES)) for r in chosen]
    return train(cut_chains, [r["y"] == 0 for r in chosen])


# -- scoring ----------------------------------------------------------------------------------
def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words that stand in a window of words found twice or more, the first time included."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    key = codes[: n - window + 1]
    for i in range(1, window):
        _, key = np.unique(key * len(numbers) + codes[i : n - window + 1 + i], return_inverse=True)
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(n, bool)
    for i in range(window):
        covered[i : n - window + 1 + i] |= twice
    return int(covered.sum())


def judge(text: str, crf: LineCrf, least_words: int, most_repeated: int, share: float) -> tuple:
    """Word statistics, the base rules' verdict, words in content lines, and the final verdict."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - (len(data) - len(data.translate(None, SPACE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    again = 0
    for line in data.split(b"\n"):
        if line.strip():
            again += line in seen
            seen.add(line)
    repeated = repeat_words(words)
    failed = n < least_words or 100 * repeated > most_repeated * n
    features, counts = cut_lines(data)
    content = int(counts[crf.decode(features) == CONTENT].sum()) if len(counts) else 0
    kept = not failed and content >= share * n
    return n, chars, symbols, again, repeated, failed, content, kept


NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "content_words", "kept",
)


def judge_lines(
    docs: DataFrame,
    crf: LineCrf,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = 50,
    most_repeated: int = 50,
    share: float = 0.5,
) -> DataFrame:
    """One row per document: id and the columns of ``NAMES``.

    A null or empty text has no words and fails the base rules. Rows that repeat are returned as
    often as they occur; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    types = [pa.bool_() if n in ("base_failed", "kept") else pa.int64() for n in NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            found = [judge(t, crf, least_words, most_repeated, share) for t in texts]
            columns = zip(*found) if found else [[]] * len(NAMES)
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *NAMES])

    schema = ", ".join(f"{n} {'boolean' if t == pa.bool_() else 'long'}" for n, t in zip(NAMES, types))
    return rows.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)
