"""Quality classifier by co-training.

Two logistic classifiers see different views of a document: the text's content (which words of a lexicon it has, shares
of characters and signs, lengths, repetition) and its metadata (language, source). The lexicon holds the ``LEXICON`` words
whose presence tells most about the labels of the examples (by the G statistic of their counts of documents, ties by word),
as far as chance alone would not give them.
Both begin with the labelled documents. In each round either
hands the other those documents without labels that it is surest of, as further examples. At the end each view is
calibrated on labelled documents that no training saw, and their odds are combined over the prior.

Only labelled documents are sampled: the ``LABELLED`` with the smallest hash of ``doc_id``, of a repeated one the row with
the smallest features. Every document without a label is in the pool. Its features are written once; a round counts how sure either view is of all of them, which gives the
bound on the odds from which documents are handed over, and each Newton step sums slopes and curves in the tasks. No row
of the pool goes to the driver. Scoring is one pass without a shuffle.

Defined results: NULL texts are empty and NULL metadata a value of its own; labels other than 0 and 1 do not count, and
of several labels of a document the mean decides, 0.5 counting as good; without documents of both labels every document
gets the score 1 and stays.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import slices, utf8
from loomwork.llm.decontamination import normalised_words
from loomwork.llm.near_dedup import mixed
from loomwork.staging import discard, staged

#: Bound of the labelled sample the classifiers are fitted on.
LABELLED = 20_000
#: Words the text view looks for, at most, and their least G statistic: by chance a word has it once in a million.
LEXICON, TELLING = 256, 24.0
ROUNDS = 5
#: What either view hands over in a round: at most this share of the pool, of documents it is this sure of.
HANDED, SURE = 0.05, 0.95
#: How strongly calibration is held back, in held-out documents.
HELD_BACK = 5.0
#: Documents below this probability of good quality are rejected.
KEEP = 0.5
_ROWS = 500
#: Rows of the sample that the driver works on at a time.
_SLICE = 1024
#: Takes the features and a random number of some documents and gives numbers that add up over documents.
Step = Callable[[tuple[np.ndarray, np.ndarray], np.ndarray], np.ndarray]
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Classes of bytes: small and capital letters, digits, blanks, line ends, each sign, other controls, non-ASCII.
_CLASS = np.full(256, 5, dtype=np.uint8)
for _c in range(256):
    _CLASS[_c] = (
        0 if 97 <= _c <= 122 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else 3 if _c == 32 else 4 if _c == 10
        else 6 if _c >= 128 else 7 + _SIGNS.index(_c) if _c in _SIGNS else 5
    )
_CLASSES = 7 + len(_SIGNS)
_LANGS, _SOURCES = 16, 64
_STYLE = _CLASSES + 7
TEXT_FEATURES = _STYLE + LEXICON
META_FEATURES = _LANGS + _SOURCES


def text_features(text: bytes | None, lexicon: dict[bytes, int] | None = None) -> np.ndarray:
    """Style of a text, and which words of the lexicon (with their places) it has."""
    text = text or b""
    present = np.zeros(LEXICON)
    if lexicon:
        present[[lexicon[w] for w in lexicon.keys() & set(normalised_words(text))]] = 1
    shares = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_CLASSES) / max(1, len(text))
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    signs = sum(not (w[0] & 0x80 or chr(w[0]).isalnum()) for w in words)
    marked = sum(not (w[-1] & 0x80 or chr(w[-1]).isalnum()) for w in words)
    extra = [
        np.log1p(len(words)), sum(map(len, words)) / n / 10, len(set(words)) / n, len(set(lines)) / len(lines),
        signs / n, marked / n, sum(len(w) == 1 for w in words) / n,
    ]
    return np.concatenate((shares, extra, present))


def _bucket(value: str | None, buckets: int) -> int:
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (buckets - 1)


def meta_features(lang: str | None, source: str | None) -> np.ndarray:
    out = np.zeros(META_FEATURES)
    out[_bucket(lang, _LANGS)] = 1
    out[_LANGS + _bucket(source, _SOURCES)] = 1
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Packed:
    """Rows of numbers as bytes: ``floats`` doubles, then a byte for each number that is 0 or 1. Only a slice is unfolded."""

    def __init__(self, data: np.ndarray, floats: int):
        self.data, self.floats = data, floats
        self.shape = (len(data), data.shape[1] - 7 * floats)

    def __len__(self) -> int:
        return len(self.data)

    def __getitem__(self, rows: slice | np.ndarray) -> np.ndarray | Packed:
        """The numbers of a slice of rows; of marked rows the bytes alone."""
        if not isinstance(rows, slice):
            return Packed(self.data[rows], self.floats)
        style = np.ascontiguousarray(self.data[rows, : 8 * self.floats]).view("<f8")
        return np.hstack((style, self.data[rows, 8 * self.floats :].astype(np.float64)))

    def __array__(self, dtype: np.dtype | None = None, copy: bool | None = None) -> np.ndarray:
        return self[:].astype(dtype or np.float64)


Rows = np.ndarray | Packed


def _slices(n: int) -> Iterator[slice]:
    return (slice(a, a + _SLICE) for a in range(0, n, _SLICE))


class Logistic(NamedTuple):
    """A linear score of standardised features, and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, x: Rows) -> np.ndarray:
        """Calibrated log odds."""
        weights = self.weights[1:] / self.scale
        score = x @ weights if isinstance(x, np.ndarray) else np.concatenate([np.zeros(0), *(x[part] @ weights for part in _slices(len(x)))])
        return self.slope * (score + (self.weights[0] - self.mean @ weights)) + self.offset


def newton(
    x: Rows, y: np.ndarray, decay: float, base: np.ndarray | float = 0.0, free: float = 1e-6, steps: int = 25,
    mean: np.ndarray | float = 0.0, scale: np.ndarray | float = 1.0,
) -> np.ndarray:
    """Weights of a logistic regression on standardised ``x`` added to the odds ``base``, the constant first.

    ``decay`` holds the weights small, ``free`` the constant. A slice of the rows is unfolded at a time.
    """
    base = np.broadcast_to(base, len(x))
    penalty = np.full(x.shape[1] + 1, decay)
    penalty[0] = free
    weights = np.zeros(len(penalty))

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for part in _slices(len(x)):
            rows = (x[part] - mean) / scale
            yield np.hstack((np.ones((len(rows), 1)), rows)), y[part], base[part]

    def costs(w: np.ndarray) -> np.ndarray:
        """Of each column of weights."""
        total = (penalty[:, None] * w * w).sum(axis=0) / 2
        for full, label, start in parts():
            odds = full @ w + start[:, None]
            total += (np.logaddexp(0, odds) - label[:, None] * odds).sum(axis=0)
        return total

    now = float(costs(weights[:, None])[0])
    for _ in range(steps):
        curve, slope = np.diag(penalty), -penalty * weights
        for full, label, start in parts():
            p = sigmoid(full @ weights + start)
            curve += (full * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ full
            slope += full.T @ (label - p)
        step = np.linalg.solve(curve, slope)
        # Shorter steps where the full one overshoots.
        then = costs(weights[:, None] + step[:, None] / 2.0 ** np.arange(12))
        k = int(then.argmin())
        if then[k] >= now - 1e-9 * (1 + abs(now)):
            break
        weights, now = weights + step / 2**k, float(then[k])
    return weights


def fitted(x: np.ndarray, y: np.ndarray) -> Logistic:
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    return Logistic(mean, scale, newton((x - mean) / scale, y, decay=1.0))


def calibrated(view: Logistic, x: Rows, y: np.ndarray) -> Logistic:
    """Slope and offset of the score that fit held-out labels best.

    Few labels move them little from 1 and 0, and count as slightly less than certain.
    """
    if not len(y):
        return view
    good, bad = y.sum(), len(y) - y.sum()
    soft = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    score = view.odds(x)
    offset, steeper = newton(score[:, None], soft, decay=HELD_BACK, base=score, free=HELD_BACK)
    return view._replace(slope=float(1 + steeper), offset=float(offset))


class Model(NamedTuple):
    text: Logistic
    meta: Logistic
    prior: float
    lexicon: dict[bytes, int] = {}

    def probabilities(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """Of good quality: by the text, by the metadata, by both."""
        a, b = self.text.odds(text), self.meta.odds(meta)
        return [sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)]


class LocalPool:
    """Documents without labels, held as arrays."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]):
        self.views, self.draw = views, mixed(np.arange(len(views[0]), dtype=np.uint64))

    def total(self, step: Step) -> np.ndarray:
        """The sum over all documents of what ``step`` gives for some."""
        return step(self.views, self.draw)


class StagedPool:
    """Documents without labels as a table of features; a step is one pass, and its sums leave each task once."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def total(self, step: Step) -> np.ndarray:
        sums = self.rows.mapInArrow(partial(_summed, step=step), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
        out = step(_no_rows(), np.zeros(0, np.uint64))
        out[sums.column("i").to_numpy()] = sums.column("x").to_numpy()
        return out


def _no_rows() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((0, TEXT_FEATURES)), np.zeros((0, META_FEATURES))


def _packed(table: pa.RecordBatch | pa.Table) -> tuple[Packed, Packed]:
    data = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8) for c in ("text", "meta"))
    text, meta = (x.reshape(-1, width) for x, width in zip(data, (8 * _STYLE + LEXICON, META_FEATURES)))
    return Packed(text, _STYLE), Packed(meta, 0)


def _unfolded(table: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    text, meta = _packed(table)
    return text[:], meta[:]


def _summed(batches: Iterator[pa.RecordBatch], step: Step) -> Iterator[pa.RecordBatch]:
    out = step(_no_rows(), np.zeros(0, np.uint64))
    for batch in batches:
        out += step(_unfolded(batch), batch.column("draw").to_numpy().view(np.uint64))
    at = np.flatnonzero(out)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], ["i", "x"])


def _moments(views: tuple[np.ndarray, ...], draw: np.ndarray) -> np.ndarray:
    return np.concatenate([[float(len(draw))], *(f for x in views for f in (x.sum(axis=0), (x * x).sum(axis=0)))])


class Handover(NamedTuple):
    """What a view handed over in a round: by label, the lowest level of odds, and the share taken of that level."""

    view: Logistic
    lowest: dict[float, tuple[int, float]]


_LEAST, _LEVELS = float(np.log(SURE / (1 - SURE))), 2048
_LABELS = ((1.0, 1), (0.0, -1))


def _level(odds: np.ndarray) -> np.ndarray:
    """Levels of odds from that of ``SURE`` on; -1 below."""
    above = np.log2(np.maximum(odds, _LEAST) / _LEAST) * 256
    return np.where(odds >= _LEAST, np.minimum(_LEVELS - 1, above.astype(np.int64)), -1)


def handed(history: list[Handover], x: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """The label each document was handed over with, NaN where it was not."""
    out = np.full(len(x), np.nan)
    for k, (view, lowest) in enumerate(history):
        odds, u = view.odds(x), mixed(draw + np.uint64(k)) / 2.0**64
        for label, sign in _LABELS:
            level, (least, share) = _level(sign * odds), lowest[label]
            out[np.isnan(out) & (level >= 0) & ((level > least) | ((level == least) & (u < share)))] = label
    return out


def _sure(views: tuple[np.ndarray, np.ndarray], draw: np.ndarray, models: list[Logistic], history: list[list[Handover]]) -> np.ndarray:
    """By view, label and level, how many documents it has not yet handed over."""
    counts = []
    for x, model, past in zip(views, models, history):
        fresh, odds = np.isnan(handed(past, x, draw)), model.odds(x)
        for _, sign in _LABELS:
            level = _level(sign * odds)
            counts.append(np.bincount(level[fresh & (level >= 0)], minlength=_LEVELS))
    return np.concatenate(counts).astype(np.float64)


def _handover(view: Logistic, counts: np.ndarray, most: dict[float, float]) -> Handover:
    """The surest documents, both labels in the shares they have, or the learner's prior would drift."""
    part = min(1.0, *(counts[i].sum() / max(most[label], 1e-9) for i, (label, _) in enumerate(_LABELS)))
    lowest = {}
    for i, (label, _) in enumerate(_LABELS):
        n, above = int(part * most[label]), np.cumsum(counts[i][::-1])[::-1]
        reached = np.flatnonzero(above >= n) if n else []
        least = int(reached[-1]) if len(reached) else _LEVELS
        lowest[label] = (least, float((n - above[least] + counts[i][least]) / counts[i][least])) if n else (_LEVELS, 0.0)
    return Handover(view, lowest)


def _slopes(views: tuple, draw: np.ndarray, models: list[Logistic], history: list[list[Handover]], open_: list[int]) -> np.ndarray:
    """Cost, slope and curve of the logistic loss of the documents handed to each view."""
    out = []
    for which in open_:
        label = handed(history[1 - which], views[1 - which], draw)
        given = ~np.isnan(label)
        out.append(_loss(models[which], views[which][given], label[given]))
    return np.concatenate(out)


def _loss(model: Logistic, x: Rows, y: np.ndarray) -> np.ndarray:
    n = len(model.weights)
    cost, slope, curve = 0.0, np.zeros(n), np.zeros((n, n))
    for part in _slices(len(x)):
        rows = (x[part] - model.mean) / model.scale
        full, label = np.hstack((np.ones((len(rows), 1)), rows)), y[part]
        odds = full @ model.weights
        p = sigmoid(odds)
        cost += (np.logaddexp(0, odds) - label * odds).sum()
        slope += full.T @ (label - p)
        curve += (full * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ full
    # The curve is symmetric; half of it travels.
    return np.concatenate(([cost], slope, curve[np.triu_indices(n)]))


def _refitted(models: list[Logistic], views: list[Rows], y: np.ndarray, pool: LocalPool | StagedPool, history: list[list[Handover]]) -> list[Logistic]:
    """Both views by Newton's method on labelled documents and those handed over; a step is one pass over the pool."""
    models, now, steps = list(models), [np.inf, np.inf], [np.zeros(len(m.weights)) for m in models]
    open_ = [0, 1]
    for _ in range(25):
        trial = [m._replace(weights=m.weights + step) for m, step in zip(models, steps)]
        sums, at = pool.total(partial(_slopes, models=trial, history=history, open_=open_)), 0
        for which in list(open_):
            w = trial[which].weights
            n = len(w)
            size = 1 + n + n * (n + 1) // 2
            found = sums[at : at + size] + _loss(trial[which], views[which], y)
            at += size
            penalty = np.full(n, 1.0)
            penalty[0] = 1e-6
            cost = float(found[0] + (penalty * w * w).sum() / 2)
            if cost <= now[which]:
                slope = found[1 : 1 + n] - penalty * w
                models[which], now[which] = trial[which], cost
                half = np.zeros((n, n))
                half[np.triu_indices(n)] = found[1 + n :]
                steps[which] = np.linalg.solve(half + np.triu(half, 1).T + np.diag(penalty), slope)
                if slope @ steps[which] < 1e-7 * (1 + cost):
                    open_.remove(which)
            else:
                steps[which] = steps[which] / 2
        if not open_:
            break
    return models


def co_trained(
    views: tuple[Rows, Rows], y: np.ndarray, held_out: np.ndarray, pool: LocalPool | StagedPool | tuple[np.ndarray, np.ndarray]
) -> Model:
    """Train both views in rounds. ``held_out`` marks labelled rows for calibration only."""
    pool = LocalPool(pool) if isinstance(pool, tuple) else pool
    train = ~held_out if len(set(y[~held_out].tolist())) == 2 else np.ones(len(y), dtype=bool)
    sums, models, at = pool.total(_moments), [], 1
    n_pool = sums[0]
    examples = [v[train] for v in views]
    for x in examples:
        # Features are standardised over the labelled documents and the whole pool.
        n, k = len(x) + n_pool, x.shape[1]
        own = sum((_moments((x[part],), y[part]) for part in _slices(len(x))), np.zeros(1 + 2 * k))
        mean, square = ((sums[a : a + k] + own[b : b + k]) / n for a, b in ((at, 1), (at + k, 1 + k)))
        at += 2 * k
        scale = np.maximum(np.sqrt(np.maximum(square - mean * mean, 0)), 1e-3)
        models.append(Logistic(mean, scale, newton(x, y[train], decay=1.0, mean=mean, scale=scale)))
    history: list[list[Handover]] = [[], []]  # by the view that hands over
    most = {label: HANDED * n_pool * (y[train] == label).mean() for label, _ in _LABELS}
    for _ in range(ROUNDS if n_pool else 0):
        # By calibrated probabilities, so a view that knows nothing is sure of nothing.
        sure = [calibrated(m, x[~train], y[~train]) for m, x in zip(models, views)]
        counts = pool.total(partial(_sure, models=sure, history=history)).reshape(2, 2, _LEVELS)
        for which in (0, 1):
            history[which].append(_handover(sure[which], counts[which], most))
        models = _refitted(models, examples, y[train], pool, history)
    models = [calibrated(m, x[~train], y[~train]) for m, x in zip(models, views)]
    good = (y.sum() + 1) / (len(y) + 2)
    return Model(models[0], models[1], float(np.log(good / (1 - good))))


def _views(batch: pa.RecordBatch, lexicon: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    meta = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
    return np.array([text_features(t, lexicon) for t in utf8(batch, "text")]), np.array([meta_features(*m) for m in meta])


def _extract(batches: Iterator[pa.RecordBatch], lexicon: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, _ROWS):
            text, meta = _views(batch, lexicon)
            rows = [
                [row[:_STYLE].astype("<f8").tobytes() + row[_STYLE:].astype(np.uint8).tobytes() for row in text],
                [row.astype(np.uint8).tobytes() for row in meta],
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.binary()) for v in rows)], ["doc_id", "text", "meta"])


def _inputs(documents: DataFrame, *more: Column) -> DataFrame:
    """The columns the views read, with their types."""
    return documents.select(*more, *(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")))


def held_out() -> Column:
    """Which labelled documents serve calibration only: a quarter, by hash."""
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(4)) == 3


def _sample(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of distinct ``doc_id`` with the smallest hash."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct word of a document, with its label."""
    for whole in batches:
        for batch in slices(whole, _ROWS):
            words, labels = [], []
            for text, label in zip(utf8(batch, "text"), batch.column("label").to_pylist()):
                found = set(normalised_words(text))
                words += found
                labels += [label] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(labels, pa.float64())], ["word", "label"])


def _telling(words: DataFrame, good: float, bad: float) -> DataFrame:
    """The ``LEXICON`` words (of ``word, label``, a row for each document) that tell most about the label."""
    counts = words.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    n, a, b = good + bad, F.col("a"), F.col("b")

    def cell(count: Column, row: Column, column: float) -> Column:
        return F.when(count > 0, count * F.log(count * n / (row * column))).otherwise(0.0)

    having, without = a + b, n - a - b
    g = cell(a, having, good) + cell(b, having, bad) + cell(good - a, without, good) + cell(bad - b, without, bad)
    return counts.select("word", F.round(2 * g, 6).alias("g")).where(F.col("g") >= TELLING).orderBy(F.desc("g"), "word").limit(LEXICON)


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    """The model; None without documents of both labels. ``labels`` has ``doc_id, label``."""
    labelled = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    inputs = _inputs(documents, F.col("doc_id").cast("long").alias("doc_id"))
    chosen = staged(_sample(inputs.select("doc_id").distinct().join(labelled.hint("merge"), "doc_id"), LABELLED))
    examples = chosen.where(~held_out())
    good, bad = (chosen.where(f"label = {label}").count() for label in (1, 0))
    if not good or not bad:
        discard(chosen)
        return None
    # At most LABELLED ids go to the texts and to the features.
    texts = inputs.select("doc_id", "text").join(F.broadcast(examples), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    words = texts.select("text", "label").mapInArrow(_present, "word binary, label double")
    good, bad = (float(examples.where(f"label = {label}").count()) for label in (1, 0))
    lexicon = {bytes(r.word): i for i, r in enumerate(_telling(words, good, bad).collect())}
    extract = partial(_extract, lexicon=lexicon)
    named, nameless = (inputs.where(f"doc_id is {x} null").mapInArrow(extract, "doc_id long, text binary, meta binary") for x in ("not", ""))
    features = named.join(labelled.hint("merge"), "doc_id", "left").unionByName(nameless.withColumn("label", F.lit(None).cast("double")))
    features = staged(features)
    least = F.min(F.struct("text", "meta")).alias("least")
    sample = features.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id", "label").agg(least)
    sample = sample.select("doc_id", "label", held_out().alias("held"), "least.*").toArrow().sort_by("doc_id")
    discard(chosen)
    y = sample.column("label").to_numpy()
    held = sample.column("held").to_numpy(zero_copy_only=False).astype(bool)
    draw = F.xxhash64("doc_id", "text", "meta").alias("draw")
    model = co_trained(_packed(sample), y, held, StagedPool(features.where("label is null").select("text", "meta", draw)))
    discard(features)
    return model._replace(lexicon=lexicon)


SCORES = ("p_text", "p_meta", "quality")


def _score(batches: Iterator[pa.RecordBatch], model: Model | None, kept: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, _ROWS):
            scores = model.probabilities(*_views(batch, model.lexicon)) if model else [np.ones(batch.num_rows)] * len(names)
            columns = [batch.column(c) for c in kept] + [pa.array(s) for s in scores]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])


def scored(documents: DataFrame, labels: DataFrame, names: tuple[str, ...] = SCORES) -> DataFrame:
    """``documents`` (``doc_id, text, lang, source`` and any others) with three probabilities of good quality.

    They are by the text, by the metadata and by both. Columns of ``documents`` with their ``names`` are replaced.
    """
    model = train(documents, labels)
    kept = [c for c in documents.columns if c not in names]
    rows = documents.select(*(F.col(c).cast("string").alias(c) if c in ("text", "lang", "source") else c for c in kept))
    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in rows.dtypes), *(f"`{c}` double" for c in names)])
    return rows.mapInArrow(partial(_score, model=model, kept=kept, names=list(names)), schema)


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not rejected."""
    longest = max(documents.columns, key=len)
    names = tuple(f"{longest}_{score}" for score in SCORES)  # no column has such a name
    rows = scored(documents, labels, names).where(F.col(names[-1]) >= KEEP)
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in documents.schema))
