"""Quality classification by co-training of a text view and a metadata view.

Two logistic regressions see different views of a document: what its text looks like, and what is
known about it (language, source, length). Each round both score all unlabelled documents, and what
one is confident of becomes a pseudo-label for the other. Both are then calibrated (Platt) on
labelled documents that no round has seen, and their calibrated log-odds are added, the prior
counted once, to score every document. A view that knows nothing calibrates to the prior and so
neither teaches nor votes.

The views of all documents are written once. What the fit needs of the unlabelled ones are sums, made
by the executors: counts per bin of score, weights per cell of the metadata view, and gradient and
curvature of the text view. Only these and a bounded sample of labelled views reach the driver. The
pseudo-labels are not stored: a row's follow from the lessons of the rounds so far.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of
from stayrate.llm.training import labelled_sample

SYMBOLS, PUNCT = b"#*$%&|<>@~^={}[]\\_", b".,;:!?"
DIGITS, UPPER = b"0123456789", bytes(range(65, 91))
#: Cells of the metadata view: hashed languages and sources, lengths by half octaves.
LANGS, SOURCES, LENGTHS = 32, 64, 48
META_FEATURES = LANGS + SOURCES + LENGTHS
TEXT_FEATURES = 14
#: Raw scores lie within this distance of 0; the pool's are counted in so many bins.
FARTHEST, BINS = 12.0, 1024


def text_view(text: str) -> list[float]:
    """What a text looks like, as shares and logarithms; zeros without a word."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * TEXT_FEATURES
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))

    def share(of: bytes) -> float:
        return (size - len(data.translate(None, of))) / size

    return [
        min(1.0, 5 * share(SYMBOLS)),
        share(DIGITS),
        share(UPPER),
        min(1.0, 5 * share(PUNCT)),
        min(1.0, 5 * share(b"|")),
        len(counts) / n,
        max(counts.values()) / n,
        same / n,
        sum(c for c in counts.values() if c > 1) / n,
        np.log1p(n),
        np.log1p((size - n) / n),
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines),
    ]


def meta_view() -> Column:
    """The metadata view: which of the features are 1 (a language, a source, a class of length)."""
    lang = F.pmod(F.xxhash64(F.coalesce(F.col("lang"), F.lit(""))), F.lit(LANGS))
    source = F.pmod(F.xxhash64(F.coalesce(F.col("source"), F.lit(""))), F.lit(SOURCES))
    chars = F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)).cast("double")
    length = F.least(F.floor(2 * F.log2(chars + 1)), F.lit(LENGTHS - 1))
    return F.array(
        lang.cast("int"), (source + LANGS).cast("int"), (length + LANGS + SOURCES).cast("int")
    )


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _ones(cells: np.ndarray) -> np.ndarray:
    """The metadata view as a matrix of zeros and ones."""
    out = np.zeros((len(cells), META_FEATURES))
    np.put_along_axis(out, cells, 1, axis=1)
    return out


def _pull(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the weighted loss at ``w``; the last column of ``x`` is 1."""
    p = _sigmoid(x @ w)
    return x.T @ (weight * (p - y)), (x * (weight * p * (1 - p))[:, None]).T @ x


def logistic(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    ridge: float,
    start: np.ndarray | None = None,
    more: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> np.ndarray:
    """Weights (the last is the intercept) by damped Newton steps.

    ``more`` gives gradient and curvature of rows that are not in ``x``.
    """
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        slope, curve = _pull(x, y, weight, w)
        if more:
            other = more(w)
            slope, curve = slope + other[0], curve + other[1]
        curve += np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope + penalty * w)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-5:
            break
    # Sums over the corpus come in any order; their last digits must not show.
    return np.round(w, 8)


@dataclass(frozen=True)
class View:
    """One classifier and its calibration. A view of cells has no mean and scale."""

    ridge: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0

    def matrix(self, x: np.ndarray) -> np.ndarray:
        return _ones(x) if self.mean is None else (x - self.mean) / self.scale

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> View:
        """Platt scaling, with a slight pull towards no slope."""
        raw = replace(self, slope=1.0, shift=0.0).raw(x)
        w = logistic(raw[:, None], y, np.ones(len(y)), 0.1)
        return replace(self, slope=max(0.0, float(w[0])), shift=float(w[1]))

    def raw(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            z = self.weights[x].sum(axis=1) + self.weights[-1]
        else:
            z = self.matrix(x) @ self.weights[:-1] + self.weights[-1]
        return np.clip(z, -FARTHEST, FARTHEST)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


@dataclass
class CoTrained:
    text: View | None
    meta: View | None
    prior: float = 0.0

    def odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated log-odds of good quality: text view, metadata view, both together."""
        if self.text is None:
            flat = np.full(len(text), self.prior)
            return flat, flat, flat
        a, b = self.text.odds(text), self.meta.odds(meta)
        return a, b, a + b - self.prior


@dataclass(frozen=True)
class Lesson:
    """What a view was sure of in one round, by log-odds and bin, and what a row of each label weighs."""

    view: View
    limit: float
    lowest: int
    highest: int
    weights: tuple[float, float] = (0.0, 0.0)

    def marks(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pseudo-labels (0, 1, or -1 for none) and bins."""
        raw = self.view.raw(x)
        bins = np.minimum((raw + FARTHEST) / (2 * FARTHEST) * BINS, BINS - 1).astype(np.int64)
        odds = self.view.slope * raw + self.view.shift
        good, poor = (odds > self.limit) & (bins >= self.highest), (odds < -self.limit) & (bins <= self.lowest)
        return np.where(good, 1, np.where(poor, 0, -1)), bins


def taught(lessons: list[Lesson], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows by the first lesson that is sure of them (else -1), and their weights."""
    label, weight = np.full(len(x), -1), np.zeros(len(x))
    for lesson in lessons:
        marks, _ = lesson.marks(x)
        new = (label < 0) & (marks >= 0)
        label[new], weight[new] = marks[new], np.take(lesson.weights, marks[new])
    return label, weight


# -- sums over the pool -----------------------------------------------------------------------
def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The text view and the metadata view of a batch."""
    out = []
    for name in ("text", "meta"):
        column = batch.column(name)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        out.append(flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), flat.dtype))
    return out


def _sums(pool: DataFrame, found: Callable[[list[np.ndarray]], tuple[np.ndarray, np.ndarray]]) -> dict[int, float]:
    """Sums of values by key, combined in every batch, in every task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, value = found(_arrays(batch))
            keys, place = np.unique(key, return_inverse=True)
            value = np.bincount(place, value, len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(value)], names=["key", "value"])

    rows = pool.select("text", "meta").mapInArrow(run, "key long, value double")
    return dict(map(tuple, rows.groupBy("key").agg(F.sum("value")).collect()))


def _score_counts(pool: DataFrame, lessons: list[list[Lesson]], now: list[Lesson]) -> np.ndarray:
    """Rows by view, label and bin that a view is sure of and has not labelled before."""

    def found(data: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys = []
        for v, x in enumerate(data):
            marks, bins = now[v].marks(x)
            new = (marks >= 0) & (taught(lessons[v], x)[0] < 0)
            keys.append((2 * v + marks[new]) * BINS + bins[new])
        key = np.concatenate(keys)
        return key, np.ones(len(key))

    out = np.zeros((2, 2, BINS))
    for key, n in _sums(pool, found).items():
        out.flat[key] = n
    return out


def _cell_weights(pool: DataFrame, lessons: list[Lesson]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the metadata view with the labels the text view gave, and the weight of each."""
    sizes = (LANGS, SOURCES, LENGTHS)
    starts = np.array([0, LANGS, LANGS + SOURCES])

    def found(data: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        label, weight = taught(lessons, data[0])
        new = label >= 0
        cell = np.ravel_multi_index((data[1][new] - starts).T.astype(np.int64), sizes)
        return 2 * cell + label[new], weight[new]

    sums = sorted(_sums(pool, found).items())
    key = np.array([k for k, _ in sums], np.int64)
    cells = np.array(np.unravel_index(key // 2, sizes)).T.reshape(-1, 3) + starts
    return cells, key % 2, np.array([w for _, w in sums], float)


def _text_pull(pool: DataFrame, view: View, lessons: list[Lesson], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the rows that the metadata view labelled, for the text view."""
    n = len(w)

    def found(data: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        label, weight = taught(lessons, data[1])
        new = label >= 0
        x = np.column_stack((view.matrix(data[0][new]), np.ones(new.sum())))
        slope, curve = _pull(x, label[new], weight[new], w)
        return np.arange(n + n * n), np.concatenate((slope, curve.ravel()))

    sums = _sums(pool, found)
    out = np.array([sums.get(i, 0.0) for i in range(n + n * n)])
    return out[:n], out[n:].reshape(n, n)


# -- training ---------------------------------------------------------------------------------
def _lesson(view: View, counts: np.ndarray, limit: float, quota: list[float], unit: float) -> Lesson:
    """The surest rows of each label: whole bins until the quota is reached, which they share."""
    up, down = np.cumsum(counts[1][::-1]), np.cumsum(counts[0])
    high, low = (min(int(np.searchsorted(c, q)), BINS - 1) for c, q in ((up, quota[1]), (down, quota[0])))
    taken = (down[low], up[high])
    weights = tuple(unit * min(1.0, q / t) if t else 0.0 for q, t in zip(quota, taken))
    return Lesson(view, limit, low, BINS - 1 - high, weights)


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    y: np.ndarray,
    pool: DataFrame,
    mean: np.ndarray,
    scale: np.ndarray,
    rounds: int,
    share: float,
    confident: float,
) -> CoTrained:
    """``y`` is 0 or 1; a third of the labelled rows is held out for calibration.

    ``pool`` holds the unlabelled rows' views (text, meta). In a round a view teaches ``share`` of
    them, by label as the labelled rows are divided, if it is at least ``confident``. All lessons
    weigh as if half the training rows had been as many as the pool, whatever its size.
    """
    held = np.arange(len(y)) % 3 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        rate = (y.sum() + 1) / (len(y) + 1)  # one kind of label or none: nothing to reject by
        return CoTrained(None, None, float(np.log(rate / (1 - rate + 1e-6))) if len(y) else 3.0)
    size = pool.count()
    rounds = rounds if size else 0
    views = [View(1.0, mean, scale), View(5.0)]
    lessons: list[list[Lesson]] = [[], []]
    train, ones = y[~held], np.ones(int((~held).sum()))
    limit = float(np.log(confident / (1 - confident)))
    quota = [float(np.ceil(share * part * size)) for part in (1 - y.mean(), y.mean())]
    for number in range(rounds + 1):
        x, rows, start = views[0].matrix(text[~held]), meta[~held], views[0].weights
        pull = (lambda w: _text_pull(pool, views[0], lessons[1], w)) if any(
            any(lesson.weights) for lesson in lessons[1]
        ) else None
        learnt = logistic(x, train, ones, views[0].ridge, start, pull)
        own = replace(views[0], weights=learnt).calibrated(text[held], y[held])
        labels, weight = train, ones
        if number:
            cells, marks, sums = _cell_weights(pool, lessons[0])
            rows, labels = np.concatenate((rows, cells)), np.concatenate((train, marks))
            weight = np.concatenate((ones, sums))
        learnt = logistic(_ones(rows), labels, weight, views[1].ridge)
        views = [own, replace(views[1], weights=learnt).calibrated(meta[held], y[held])]
        if number < rounds:
            now = [Lesson(view, limit, BINS - 1, 0) for view in views]
            counts = _score_counts(pool, lessons, now)
            unit = 0.5 * len(train) / size
            for v in (0, 1):
                lessons[v].append(_lesson(views[v], counts[v], limit, quota, unit))
    return CoTrained(*views, float(np.log(y.mean() / (1 - y.mean()))))


def view_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and meta view of every row, written; whole texts are read once, nothing is shuffled."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), meta_view().alias("meta"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            view = pa.array([text_view(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), view, batch.column(2)], names=["id", "text", "meta"])

    return staged(rows.mapInArrow(run, f"id {kind}, text array<double>, meta array<int>"), "views")


def fit_views(
    views: DataFrame,
    labels: DataFrame,
    rows: int = 3000,
    rounds: int = 4,
    share: float = 0.05,
    confident: float = 0.95,
    id_col: str = "doc_id",
) -> CoTrained:
    """Train on at most ``rows`` labelled documents (by a hash of the id) and all unlabelled ones.

    Without labels of both kinds every document gets the same score, which keeps it unless all
    labels are poor.
    """
    known = labelled_sample(views, labels, "quality", rows, id_col, ["text", "meta"], "id")
    known = sorted(known.collect(), key=lambda r: (str(r["id"]), r["id"]))
    # Not an aggregate of the labels: beside a plain side the engine can split ids that are hot.
    pool = views.join(labels.select(F.col(id_col).alias("id")), "id", "left_anti").select("text", "meta")
    pool = staged(pool, "pool")
    sums = views.select(
        *(f(F.get("text", F.lit(i))) for i in range(TEXT_FEATURES) for f in (F.avg, F.stddev_pop))
    ).first()
    mean, scale = (np.array([v or 0.0 for v in sums[at::2]]) for at in (0, 1))
    scale = np.where(scale > 1e-9, scale, 1.0)
    text = np.array([r["text"] for r in known], float).reshape(-1, TEXT_FEATURES)
    meta = np.array([r["meta"] for r in known], np.int64).reshape(-1, 3)
    y = np.array([r["y"] for r in known], np.int64)
    return co_train(text, meta, y, pool, np.round(mean, 8), np.round(scale, 8), rounds, share, confident)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options
) -> CoTrained:
    """As ``fit_views``, on documents with the columns lang, source and n_chars."""
    return fit_views(view_table(docs, id_col, text_col), labels, id_col=id_col, **fit_options)


SCORES = ("text_score", "meta_score", "score")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = 0.5,
    **fit_options,
) -> DataFrame:
    """One row per document: id, text_score, meta_score, score (calibrated), kept (score >= least).

    Nulls in text, lang, source and n_chars count as empty or 0. Rows that repeat are returned as
    often as they occur; other columns are ignored.
    """
    views = view_table(docs, id_col, text_col)
    model = fit_views(views, labels, id_col=id_col, **fit_options)
    kind = dict(views.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                odds = [pa.array(_sigmoid(z), pa.float64()) for z in model.odds(*_arrays(batch))]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *odds], names=["id", *SCORES])

    found = views.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} double" for n in SCORES))
    return found.withColumnRenamed("id", id_col).withColumn("kept", F.col("score") >= least)


def keep_good(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with their columns.

    Texts are read again for it rather than joined with their scores, as ids may repeat or be null.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)

    @F.pandas_udf("double")
    def score(texts: pd.Series, meta: pd.Series) -> pd.Series:
        view = np.array([text_view(t) for t in texts], float).reshape(-1, TEXT_FEATURES)
        cells = np.array(meta.tolist(), np.int64).reshape(-1, 3)
        return pd.Series(_sigmoid(model.odds(view, cells)[2]))

    return docs.where(score(text_of(text_col), meta_view()) >= least)
