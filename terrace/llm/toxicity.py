"""Toxicity by compression distance to zstandard dictionaries.

Two dictionaries are trained, on labelled toxic and on ordinary text. Both end
with the same common words of ordinary text; before them each holds the words
that its own class uses significantly more often, all of them, so a window of text
compresses to different lengths only where it holds something typical of one
class. A text is cut into windows of about ``WINDOW`` bytes at word ends, each
is compressed with either dictionary, and the differences in length give the
score through a logistic threshold calibrated on the labelled sample: their mean
and the share of telling ones, the mean of the largest three, and how far
large ones outnumber what chance gives for so many windows. The last two don't
shrink with length, so a toxic passage is not averaged away in a long text; the
sample has long texts too, put together from its own.

How often a word is used is counted by the texts that have it in a new context
(the words beside it), so that neither copies of one text nor a text that
repeats its own words count more than once.

Scale: the model is learned from a bounded sample of labelled rows
(``SAMPLE_TOXIC``, ``SAMPLE_ORDINARY`` texts of at most ``SAMPLE_TEXT_BYTES``)
and broadcast; scoring is one narrow pass over whole texts.

Defined results: a null or empty text, and one without letters, has no
difference and gets the score of such a text. If one class has no labelled
row, every score is that class's share (0 without labels). Rows with a null
label, and labels of no document, teach nothing; of several labels of an id
the highest counts. Repeated rows are scored alike.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import id_remainder, text_chunks
from terrace.llm.words import SEPARATOR, Words, hashes, letters, mix

WINDOW = 48
TELLING = 2  # bytes of difference that few ordinary windows show
LARGEST = 3
MOST_BYTES = 24  # larger differences count as this one
LONG_TEXTS = 150  # of either class for the calibration, of up to LONG_WINDOWS windows
LONG_WINDOWS = 4_000
WINDOW_SLACK = 24  # a window ends at a word end if one comes within so many bytes
LEVEL = 9
SHORTEST_MATCH = 4
SAMPLE_TOXIC = 2_000
SAMPLE_ORDINARY = 3_500
SAMPLE_TEXT_BYTES = 16_000
COMMON_WORDS = 1_000
LEAST_EVIDENCE = 4.0  # standard deviations from the classes' common rate
LEAST_CONTEXTS = 5
LEAST_LETTERS = 3
HELD_OUT = 5


class _Usage(NamedTuple):
    """Texts with a new context of each word, by hash, and an example of the word."""

    key: np.ndarray
    contexts: np.ndarray
    example: list[bytes]


def _usage(texts: list[bytes]) -> _Usage:
    words, contexts, numbers, examples = [], [], [], {}
    for number, text in enumerate(texts):
        low = np.frombuffer(text, np.uint8)
        space = low == SEPARATOR
        inside = ~space
        start = np.flatnonzero(inside & np.r_[True, space[:-1]])
        end = np.flatnonzero(inside & np.r_[space[1:], True]) + 1
        if not len(start):
            continue
        h = hashes(Words(low, start, end, np.array([0, len(start)])))
        beside = mix(np.r_[np.uint64(0), h[:-1]]) * np.uint64(3) ^ mix(np.r_[h[1:], np.uint64(0)])
        words.append(h)
        contexts.append(mix(h * np.uint64(5) ^ beside))
        numbers.append(np.full(len(h), number, np.uint64))
        for k, s, e in zip(h.tolist(), start.tolist(), end.tolist()):
            if k not in examples:
                examples[k] = text[s:e]
    if not words:
        return _Usage(np.empty(0, np.uint64), np.empty(0, np.int64), [])
    all_words, all_contexts, all_numbers = np.concatenate(words), np.concatenate(contexts), np.concatenate(numbers)
    first = np.unique(all_contexts, return_index=True)[1]
    once = np.unique(mix(all_words[first] * np.uint64(5) ^ mix(all_numbers[first])), return_index=True)[1]
    key, count = np.unique(all_words[first][once], return_counts=True)
    return _Usage(key, count, [examples[k] for k in key.tolist()])


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Words typical of toxic and of ordinary text, the strongest first, and the common words of ordinary text."""
    t, o = _usage(toxic), _usage(ordinary)
    key = np.union1d(t.key, o.key)
    counts = np.zeros((2, len(key)))
    example: dict[int, bytes] = {}
    for row, usage in enumerate((t, o)):
        counts[row, np.searchsorted(key, usage.key)] = usage.contexts
        example.update(zip(usage.key.tolist(), usage.example))
    both = counts.sum(axis=0)
    rate = counts[0].sum() / max(1.0, counts.sum())
    evidence = (counts[0] - both * rate) / np.sqrt(both * rate * (1 - rate) + 1)
    # Common words are those that ordinary text uses, and not mostly toxic text.
    ordinary_too = (counts[1] > 0) & (counts[1] >= 0.5 * both * (1 - rate))
    order = np.lexsort((key, -counts[1]))
    common = [example[int(k)] for k in key[order[ordinary_too[order]]][:COMMON_WORDS]]
    usual = set(common)
    chosen = []
    for signed in (evidence, -evidence):
        order = np.lexsort((key, -signed))
        strong = order[(signed[order] >= LEAST_EVIDENCE) & (both[order] >= LEAST_CONTEXTS)]
        words = [example[int(k)] for k in key[strong]]
        chosen.append([w for w in words if w not in usual and len(w) >= LEAST_LETTERS])
    return chosen[0], chosen[1], common


def _dictionaries(typical: tuple[list[bytes], list[bytes]], common: list[bytes]) -> tuple[bytes, bytes]:
    """For each class all its typical words, in parts of one size, then the common words, the most frequent last."""
    parts = [b" " + b" ".join(reversed(words)) + b" " for words in typical]
    size = max(map(len, parts))
    end = b" ".join(reversed(common)) + b" "
    return parts[0].rjust(size) + end, parts[1].rjust(size) + end


def _windows(text: bytes) -> list[bytes]:
    """Windows of about ``WINDOW`` bytes that begin and end at separators where possible."""
    out, at, size = [], 0, len(text)
    while at < size - 1:
        to = min(size, at + WINDOW)
        if to < size:
            space = text.find(b" ", to, to + WINDOW_SLACK)
            if space >= 0:
                out.append(text[at : space + 1])
                at = space
                continue
        out.append(text[at:to])
        at = to
    return out


FEATURES = 5


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray  # of the standardised features, the constant last
    centre: np.ndarray
    spread: np.ndarray
    chance: np.ndarray  # share of the ordinary windows with a difference of so many bytes or more
    constant: float | None  # the score of every text, where nothing could be learned

    def _compressors(self):
        settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=SHORTEST_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False)
        out = []
        for content in (self.toxic, self.ordinary):
            trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            trained.precompute_compress(compression_params=settings)
            out.append(zstandard.ZstdCompressor(dict_data=trained, compression_params=settings).compress)
        return out

    def differences(self, texts) -> list[np.ndarray]:
        """How many bytes shorter the toxic dictionary makes each window of each (normalised) text."""
        toxic, ordinary = self._compressors()
        return [np.array([len(ordinary(w)) - len(toxic(w)) for w in _windows(text)], np.int64) for text in texts]

    def features(self, differences: list[np.ndarray]) -> np.ndarray:
        """Mean, share of telling ones, log number, mean of the largest and excess over chance of each text's differences."""
        out = []
        for far in differences:
            n = max(1, len(far))
            largest = np.sort(far)[-LARGEST:].clip(0).sum() / LARGEST
            out.append((far.sum() / n, (far >= TELLING).sum() / n, np.log(n), largest, _excess(far, self.chance)))
        return np.array(out, float).reshape(-1, FEATURES)

    def scores(self, array: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(array), self.constant)
        features = np.concatenate([self.features(self.differences(_letters(data, offsets))) for _, data, offsets in text_chunks(array)]) if len(array) else np.empty((0, FEATURES))
        return _logistic((features - self.centre) / self.spread, self.weights)


def _at_least(far: np.ndarray) -> np.ndarray:
    """How many differences are of so many bytes or more, from 0 to MOST_BYTES."""
    return np.bincount(far.clip(0, MOST_BYTES), minlength=MOST_BYTES + 1)[::-1].cumsum()[::-1]


def _excess(far: np.ndarray, chance: np.ndarray) -> float:
    """How surprising the most surprising number of large differences is, in standard deviations.

    For each size from ``TELLING`` on, the number found is set against the
    number that ordinary windows give by chance (a Poisson likelihood ratio).
    """
    found = _at_least(far)[TELLING:]
    expected = len(far) * chance[TELLING:]
    more = found > expected
    if not more.any():
        return 0.0
    found, expected = found[more], expected[more]
    return float(np.sqrt(2 * np.max(found * np.log(found / expected) - found + expected)))


def _long(own: list[np.ndarray], ordinary: list[np.ndarray], number: int) -> list[np.ndarray]:
    """Differences of long texts: one text of ``own`` each, and ordinary ones up to lengths spread evenly in the logarithm."""
    rng, out = np.random.default_rng(len(own)), []
    for size in np.geomspace(LONG_WINDOWS // 20, LONG_WINDOWS, number):
        parts = [own[rng.integers(len(own))]]
        while sum(map(len, parts)) < size and len(parts) < LONG_WINDOWS:
            parts.append(ordinary[rng.integers(len(ordinary))])
        out.append(np.concatenate(parts))
    return out


def _letters(data: np.ndarray, offsets: np.ndarray):
    clean, offsets = letters(data, offsets)
    body = clean.tobytes()
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield b" " + body[begin:end].strip(b" ") + b" "


def _logistic(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))


def _calibrate(features: np.ndarray, label: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.c_[features, np.ones(len(features))]
    ridge = np.diag([0.1] * features.shape[1] + [1e-6])
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = _logistic(features, weights)
        gradient = x.T @ (importance * (label - p)) - ridge @ weights
        curve = (x * (importance * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, gradient)
        weights += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _cut(logit: np.ndarray, label: np.ndarray, importance: np.ndarray) -> float:
    """The logit from which on the label 1 gains most: what is above it counts more ones than what it takes in of the others.

    Labels that no word explains pull the regression towards the middle; the
    score is shifted so that 0.5 stands where the classes part. 0 if no cut gains.
    """
    order = np.argsort(-logit, kind="stable")
    gain = np.cumsum(np.where(label[order] == 1, importance[order], -importance[order]))
    tied = np.r_[np.diff(logit[order]) > -1e-9, False]  # texts of one logit are not parted
    last = int(np.where(tied, -np.inf, gain).argmax())
    if gain[last] <= 0:
        return 0.0
    after = order[min(last + 1, len(order) - 1)]
    return float((logit[order[last]] + logit[after]) / 2)


def train(toxic: list[str], ordinary: list[str], odds: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Dictionaries and calibration from texts of both classes; ``odds``: rows that a text of either class stands for."""
    none = np.zeros(FEATURES)
    if not toxic or not ordinary:
        return Model(b"", b"", none, none, none, none, 1.0 if toxic else 0.0)
    clean = []
    for texts in (toxic, ordinary):
        raw = [t.encode() for t in texts]
        clean.append(list(_letters(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])))
    typical_toxic, typical_ordinary, common = _typical(*clean)
    model = Model(*_dictionaries((typical_toxic, typical_ordinary), common), none, none, none, none, None)
    far = [model.differences(texts) for texts in clean]
    windows = np.concatenate(far[1])
    # One window more of each size: what no ordinary window showed is rare, not impossible.
    model = model._replace(chance=(_at_least(windows) + 1) / (len(windows) + 1))
    label = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary)), np.ones(LONG_TEXTS), np.zeros(LONG_TEXTS)]
    features = model.features([*far[0], *far[1], *_long(far[0], far[1], LONG_TEXTS), *_long(far[1], far[1], LONG_TEXTS)])
    importance = np.where(label == 1, odds[0], odds[1])
    centre, spread = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-6)
    weights = _calibrate((features - centre) / spread, label, importance / importance.mean())
    weights[-1] -= _cut((features - centre) / spread @ weights[:-1] + weights[-1], label, importance)
    return model._replace(weights=weights, centre=centre, spread=spread)


def learn(docs: DataFrame, labels: DataFrame, divisor: int = HELD_OUT, sample_toxic: int = SAMPLE_TOXIC, sample_ordinary: int = SAMPLE_ORDINARY) -> Model:
    """A model from labelled rows whose id has a remainder other than 0; only the bounded sample reaches the driver."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder("doc_id", divisor) != 0))
    marked = marked.groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = {True: min(1.0, sample_toxic / max(1, counts.get(True, 0))), False: min(1.0, sample_ordinary / max(1, counts.get(False, 0)))}
    drawn = F.pmod(F.xxhash64(F.lit(divisor), F.col("doc_id")), F.lit(1 << 31)) < F.when(F.col("toxic"), share[True]).otherwise(share[False]) * F.lit(float(1 << 31))
    sample = F.broadcast(marked.where(drawn))
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= SAMPLE_TEXT_BYTES).join(sample, "doc_id")
    rows = rows.select("text", "toxic").groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("text").alias("text"))
    classes: tuple[list, list] = ([], [])
    for h, toxic, text in rows.toLocalIterator():
        classes[not toxic].append((h, text))
    toxic, ordinary = ([t for _, t in sorted(c)] for c in classes)
    return train(toxic, ordinary, (1 / share[True], 1 / share[False]))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``score`` and ``predicted`` of each document."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            values = shared.value.scores(batch.column(batch.num_columns - 1))
            columns = [*batch.columns[:-1], pa.array(values, pa.float64()), pa.array((values >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return kept.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held_out (a fifth, by id), the score and the prediction."""
    return score(docs, learn(docs, labels), keep=("doc_id", (id_remainder("doc_id", HELD_OUT) == 0).alias("held_out")))
