"""Hashed maximum-entropy language model with a class-factored softmax.

p(token | before) = p(class | before) x p(token | class, before). The ``HEADS``
most frequent tokens form classes of ``CLASS`` tokens by frequency; all other
tokens, unknown ones included, fall into ``TAILS`` classes by their last byte.
The class, and the token within a class of frequent ones, are softmaxes over
hashed features of the tokens before: the last one, the last two (n-grams), and
the one before the last (skip). Within a tail class a token has the smoothed
share (c + 1) / (class tokens + different class tokens + 1), so every
distribution sums to 1, with one unknown token in each tail class.

Training: counts cover all training texts. The feature weights are learned by
rounds of distributed gradient steps: in a round every task runs AdaGrad over
its part of the round's texts, starting from the current weights, and the
tasks' changes are averaged, each feature by how often a task met it. Every
training text is in one round.

Scoring: the counts of the ``DICTIONARY`` most frequent tokens are broadcast
(a fixed bound); the other tokens of a document meet their counts in a join on
the token, which no frequent token takes part in.

Defined results: a null or empty text has one token, its end. A null id counts
as the empty text in the choice of training rows. Without training rows both
scores are those of a uniform choice over nothing known: 0. Repeated rows
train and are scored as often as they stand there.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import id_remainder, materialize, text_chunks
from terrace.llm.words import NOT_SPACE, HashIndex, cut, hashes, mix

DICTIONARY = 1 << 17  # frequent tokens whose counts are broadcast, at most
CLASS = 32
HEADS = 1024
TAILS = 32
CLASSES = HEADS // CLASS + TAILS
CLASS_ROWS = 1 << 14  # hashed features of the class softmax
TOKEN_ROWS = 1 << 15  # hashed features of the softmax within a class
ROUNDS = 2
MINIBATCH = 8192
CACHED = 1024  # rows of a matrix worked on together, so that they stay in the processor's cache
FEW = 8  # sums of up to this many rows are built row by row
TOKENS_OF_TASK = 5_000_000  # of a round, at least, where there are more tasks than cores
RATE = 0.15
END = b"\n"  # no token holds white space
HELD_OUT = 7, 2  # divisor and remainder of the rows not trained on
BLOCK_ROWS = 512  # of a table, averaged together
ABSENT = -1e4  # logit of a class or token that doesn't exist

_BEFORE_TEXT = HEADS + TAILS  # context of a text's first token


class Tokens(NamedTuple):
    """Tokens of a run of texts, each text followed by its end."""

    place: np.ndarray  # in the dictionary (0: the end), or -1
    tail: np.ndarray  # last byte modulo TAILS
    row: np.ndarray
    start: np.ndarray  # in ``low``; ends have none
    stop: np.ndarray
    low: np.ndarray
    key: np.ndarray  # hash


def tokens(data: np.ndarray, offsets: np.ndarray, index: HashIndex) -> Tokens:
    words = cut(data, offsets, NOT_SPACE)
    texts, count = len(offsets) - 1, len(words.start)
    size = np.diff(words.first)
    row = np.repeat(np.arange(texts), size)
    at = np.arange(count) + row
    total = count + texts
    place, tail = np.zeros(total, np.int32), np.zeros(total, np.int64)
    start, stop = np.zeros(total, np.int64), np.zeros(total, np.int64)
    key = np.zeros(total, np.uint64)
    h = hashes(words)
    key[at] = h
    place[at] = index.find(h)
    tail[at] = words.low[words.end - 1] % TAILS if count else 0
    start[at], stop[at] = words.start, words.end
    return Tokens(place, tail, np.repeat(np.arange(texts), size + 1), start, stop, words.low, key)


class Model(NamedTuple):
    index: HashIndex  # of the dictionary's tokens, the end first, then by falling count
    count: np.ndarray  # c of each token of the dictionary
    total: int  # N
    different: int  # V
    tail_log: np.ndarray  # log10 of class tokens + different class tokens + 1
    class_bias: np.ndarray
    token_bias: np.ndarray  # classes of frequent tokens x CLASS
    class_rows: np.ndarray
    token_rows: np.ndarray

    def contexts(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class and place in the class (-1 in a tail class) of each token, and the last and last but one contexts."""
        head = (t.place >= 0) & (t.place < HEADS)
        unit = np.where(head, t.place, HEADS + t.tail)
        klass = np.where(head, t.place // CLASS, HEADS // CLASS + t.tail)
        inside = np.where(head, t.place % CLASS, -1)
        one, two = np.full(len(unit), _BEFORE_TEXT), np.full(len(unit), _BEFORE_TEXT)
        one[1:] = np.where(t.row[1:] == t.row[:-1], unit[:-1], _BEFORE_TEXT)
        two[2:] = np.where(t.row[2:] == t.row[:-2], unit[:-2], _BEFORE_TEXT)
        return klass, inside, one, two

    def class_features(self, one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
        return [_feature(CLASS_ROWS, 1, one), _feature(CLASS_ROWS, 2, two), _feature(CLASS_ROWS, 3, one, two)]

    def token_features(self, klass: np.ndarray, one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
        return [_feature(TOKEN_ROWS, 4, klass, one), _feature(TOKEN_ROWS, 5, klass, two)]

    def log_probabilities(self, t: Tokens) -> np.ndarray:
        """log10 p of each token; in a tail class without the count, so (c + 1) is still to be multiplied."""
        klass, inside, one, two = self.contexts(t)
        # The class depends on the two contexts only, so its softmax is made once for each different pair.
        pairs, pair = _places(one * (_BEFORE_TEXT + 1) + two, (_BEFORE_TEXT + 1) ** 2)
        features = self.class_features(*np.divmod(pairs, _BEFORE_TEXT + 1))
        top, log_sum = _tops(self.class_bias, self.class_rows, features)
        out = np.empty(len(klass))
        for begin in range(0, len(klass), MINIBATCH):
            part = slice(begin, begin + MINIBATCH)
            k, p = klass[part], pair[part]
            at = [f.take(p) * CLASSES + k for f in features]
            logit = self.class_rows.take(at[0]) + self.class_bias.take(k)
            for a in at[1:]:
                logit += self.class_rows.take(a)
            log_p = (logit - top.take(p) - log_sum.take(p)) / np.log(10)
            head = np.flatnonzero(inside[part] >= 0)
            hk = k[head]
            tokens_at = self.token_features(hk, one[part][head], two[part][head])
            log_p[head] += _log_softmax_at(self.token_bias, self.token_rows, tokens_at, inside[part][head], hk) / np.log(10)
            rare = np.flatnonzero(inside[part] < 0)
            log_p[rare] -= self.tail_log[k[rare] - HEADS // CLASS]
            out[part] = log_p
        return out


def _feature(rows: int, kind: int, *parts: np.ndarray) -> np.ndarray:
    key = np.full(len(parts[0]), kind, np.uint64)
    for part in parts:
        key = key * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64) + np.uint64(1)
    return (mix(key) % np.uint64(rows)).astype(np.int64)


def _places(numbers: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ``numbers`` (from 0, under ``below``), and each one's place among them."""
    seen = np.zeros(below, bool)
    seen[numbers] = True
    different = np.flatnonzero(seen)
    place = np.empty(below, np.int32)
    place[different] = np.arange(len(different), dtype=np.int32)
    return different, place[numbers]


def _logits(bias: np.ndarray, rows: np.ndarray, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits less the largest one of their row, and those."""
    out = rows.take(features[0], axis=0)
    out += bias
    for f in features[1:]:
        out += rows.take(f, axis=0)
    top = out.max(axis=1)
    out -= top[:, None]
    return out, top


def _parts(bias: np.ndarray, features: list[np.ndarray], which: np.ndarray | None):
    """(slice, bias, features) of ``CACHED`` rows at a time; ``which``: the row of ``bias`` that each row takes."""
    for begin in range(0, len(features[0]), CACHED):
        part = slice(begin, begin + CACHED)
        yield part, bias if which is None else bias.take(which[part], axis=0), [f[part] for f in features]


def _tops(bias: np.ndarray, rows: np.ndarray, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The largest logit of each row, and the log of the sum of the exponentials of those less it."""
    top, log_sum = np.empty(len(features[0]), rows.dtype), np.empty(len(features[0]), rows.dtype)
    for part, b, f in _parts(bias, features, None):
        out, top[part] = _logits(b, rows, f)
        log_sum[part] = np.log(np.exp(out, out=out).sum(axis=1))
    return top, log_sum


def _log_softmax_at(bias: np.ndarray, rows: np.ndarray, features: list[np.ndarray], label: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
    """The log of each row's softmax at its label."""
    found = np.empty(len(label), rows.dtype)
    for part, b, f in _parts(bias, features, which):
        out, _ = _logits(b, rows, f)
        at_label = out[np.arange(len(out)), label[part]]
        found[part] = at_label - np.log(np.exp(out, out=out).sum(axis=1))
    return found


def _row_sums(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, rows in it, sum of its rows of ``values``) of each different group, in no order.

    Most groups have few rows. Those are added up row by row for all groups
    together, in the order in which ``reduceat`` adds, which does the others.
    """
    order = np.argsort(group.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
    in_order = group[order]
    first = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]])
    times = np.diff(np.r_[first, len(order)])
    falling = np.argsort(-np.minimum(times, FEW + 1).astype(np.int8), kind="stable")
    first, times = first[falling], times[falling]
    more = [int(np.count_nonzero(times > k)) for k in range(FEW + 1)]  # groups of more than k rows: the first ones
    many = more[FEW]
    sums = values.take(order[first], axis=0)
    if many:
        length = times[:many]
        begin = np.cumsum(length) - length
        at = np.arange(begin[-1] + length[-1]) + np.repeat(first[:many] - begin, length)
        sums[:many] = np.add.reduceat(values.take(order[at], axis=0), begin, axis=0)
    if more[1] > many:
        rest = values.take(order[first[many : more[1]] + 1], axis=0)
        for k in range(2, FEW):
            rest[: more[k] - many] += values.take(order[first[many : more[k]] + k], axis=0)
        sums[many : more[1]] += rest
    return in_order[first], times, sums


class _Trainer:
    """AdaGrad over one task's texts; remembers how often each feature row was met."""

    def __init__(self, model: Model):
        self.start = model
        self.model = model._replace(class_rows=model.class_rows.copy(), token_rows=model.token_rows.copy())
        self.squares = [np.full_like(model.class_rows, 1e-3), np.full_like(model.token_rows, 1e-3)]
        self.met = [np.zeros(CLASS_ROWS, np.float32), np.zeros(TOKEN_ROWS, np.float32)]

    def learn(self, t: Tokens) -> None:
        klass, inside, one, two = self.model.contexts(t)
        for begin in range(0, len(klass), MINIBATCH):
            part = slice(begin, begin + MINIBATCH)
            k, o, w = klass[part], one[part], two[part]
            self._step(0, self.model.class_bias, self.model.class_rows, self.model.class_features(o, w), k)
            head = np.flatnonzero(inside[part] >= 0)
            if len(head):
                hk = k[head]
                self._step(1, self.model.token_bias, self.model.token_rows, self.model.token_features(hk, o[head], w[head]), inside[part][head], hk)

    def _step(self, table: int, bias: np.ndarray, rows: np.ndarray, features: list[np.ndarray], label: np.ndarray, which: np.ndarray | None = None) -> None:
        slope = np.empty((len(label), rows.shape[1]), rows.dtype)
        for part, b, f in _parts(bias, features, which):
            out = np.exp(_logits(b, rows, f)[0], out=slope[part])
            out /= out.sum(axis=1, keepdims=True)
            out[np.arange(len(out)), label[part]] -= 1
        squares, met = self.squares[table], self.met[table]
        for feature in features:
            row, times, sums = _row_sums(slope, feature)
            met[row] += times
            for begin in range(0, len(row), CACHED):
                r, change = row[begin : begin + CACHED], sums[begin : begin + CACHED]
                square = squares.take(r, axis=0)
                square += change * change
                squares[r] = square
                change *= RATE
                change /= np.sqrt(square, out=square)
                weights = rows.take(r, axis=0)
                weights -= change
                rows[r] = weights

    def changes(self):
        """(table, block, weighted change and weights as bytes) of the blocks that were met."""
        for table, (now, before) in enumerate(((self.model.class_rows, self.start.class_rows), (self.model.token_rows, self.start.token_rows))):
            for at in range(0, len(now), BLOCK_ROWS):
                met = self.met[table][at : at + BLOCK_ROWS]
                if met.any():
                    change = (now[at : at + BLOCK_ROWS] - before[at : at + BLOCK_ROWS]) * met[:, None]
                    yield table, at // BLOCK_ROWS, change.astype(np.float32).tobytes(), met.tobytes()


_CHANGES = T.StructType([T.StructField("tab", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("change", T.BinaryType()), T.StructField("met", T.BinaryType())])
_CHANGES_ARROW = pa.schema([("tab", pa.int32()), ("block", pa.int32()), ("change", pa.binary()), ("met", pa.binary())])


def _round(texts: DataFrame, model: Model, rounds: int) -> Model:
    """One round of local training over ``texts`` (one text column) and the average of the tasks' changes."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def train(batches):
        trainer = _Trainer(shared.value)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                trainer.learn(tokens(data, offsets, trainer.model.index))
        for change in trainer.changes():
            yield pa.RecordBatch.from_pylist([dict(zip(_CHANGES_ARROW.names, change))], _CHANGES_ARROW)

    def add(batches):
        # One block's rows come one after another to one task; only its sums are held.
        sums: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for tab, block, change, met in zip(*(batch.column(i).to_pylist() for i in range(4))):
                new = [np.frombuffer(change, np.float32), np.frombuffer(met, np.float32)]
                if (tab, block) in sums:
                    for total, more in zip(sums[tab, block], new):
                        total += more
                else:
                    sums[tab, block] = [x.astype(np.float64) for x in new]
        for (tab, block), (change, met) in sums.items():
            row = (tab, block, change.astype(np.float32).tobytes(), met.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_pylist([dict(zip(_CHANGES_ARROW.names, row))], _CHANGES_ARROW)

    rows = [model.class_rows.copy(), model.token_rows.copy()]
    # A task gives back up to 8 MB whatever it has read, so it reads enough for that.
    tasks = max(spark.sparkContext.defaultParallelism, model.total // rounds // TOKENS_OF_TASK)
    averaged = texts.coalesce(tasks).mapInArrow(train, _CHANGES).repartition("tab", "block").mapInArrow(add, _CHANGES)
    for tab, block, change, met in averaged.toLocalIterator():
        weight = np.frombuffer(met, np.float32)
        at = slice(block * BLOCK_ROWS, block * BLOCK_ROWS + len(weight))
        rows[tab][at] += np.frombuffer(change, np.float32).reshape(len(weight), -1) / np.maximum(weight, 1)[:, None]
    shared.destroy()
    return model._replace(class_rows=rows[0], token_rows=rows[1])


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, c): how often each token, the end included, is in the texts (one text column)."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])

    def run(batches):
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                words = cut(data, offsets, NOT_SPACE)
                _, first, count = np.unique(hashes(words), return_index=True, return_counts=True)
                low = words.low.tobytes()
                found = [low[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([END, *found], pa.binary()), pa.array(np.r_[len(offsets) - 1, count].astype(np.int64))], names=["word", "c"])

    return texts.mapInArrow(run, schema).groupBy("word").agg(F.sum("c").alias("c"))


def _least_count(counts: DataFrame) -> int:
    """The least count that, with all higher ones, at most ``DICTIONARY - 1`` tokens have.

    Counts are looked at with their 8 leading bits, so few groups reach the driver.
    """
    shift = F.greatest(F.lit(0), F.length(F.bin("c")) - 8)
    group = F.expr("shiftleft(shiftright(c, least), least)")
    groups = counts.withColumn("least", shift).groupBy(group.alias("least")).agg(F.count("*").alias("n")).collect()
    least, room = 1 << 62, DICTIONARY - 1
    for value, n in sorted(groups, reverse=True):
        if n > room:
            break
        least, room = value, room - n
    return least


def fit(docs: DataFrame, trains: Column, text: str = "text", doc_id: str = "doc_id", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of the rows for which ``trains`` holds, and the counts of all their tokens."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    training = docs.where(trains)
    counts = materialize(spark, token_counts(training.select(body)), "lm-counts")
    total, different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    is_end = F.col("word") == F.lit(bytearray(END))
    ends = counts.where(is_end).select("c").first()
    head = counts.where(~is_end & (F.col("c") >= _least_count(counts.where(~is_end)))).toArrow()
    order = np.lexsort((np.array(head["word"].to_pylist(), object), -head["c"].to_numpy())) if head.num_rows else np.empty(0, np.int64)
    word = [END, *head["word"].take(pa.array(order, pa.int64())).to_pylist()]
    count = np.r_[ends["c"] if ends else 0, head["c"].to_numpy()[order]].astype(np.int64)
    # Tokens and different tokens of each tail class: all but the frequent ones.
    classes = np.zeros((2, TAILS))
    for last, c, v in counts.groupBy(F.substring("word", -1, 1)).agg(F.sum("c"), F.count("*")).collect():
        classes[:, last[0] % TAILS] += c, v
    for w, c in zip(word[:HEADS], count):
        if c:
            classes[:, w[-1] % TAILS] -= c, 1
    heads = np.zeros(HEADS)
    heads[: min(HEADS, len(count))] = count[:HEADS]
    heads = heads.reshape(-1, CLASS)
    present = np.arange(HEADS).reshape(-1, CLASS) < len(count)
    token_bias = np.where(present, np.log(heads + 0.5), ABSENT)
    mass = np.r_[np.where(present.any(axis=1), np.log(heads.sum(axis=1) + 0.5), ABSENT), np.log(classes[0] + 1)]
    # The end has no bytes to hash; its place is given to it, not looked up.
    keys = [0, *_hash_all(word[1:])]
    model = Model(
        HashIndex(np.array(keys, np.uint64)), count, int(total), int(different), np.log10(classes.sum(axis=0) + 1),
        mass.astype(np.float32), token_bias.astype(np.float32), np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((TOKEN_ROWS, CLASS), np.float32),
    )
    if total:
        for turn in range(rounds):
            share = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(rounds)) == turn
            model = _round(training.where(share).select(body), model, rounds)
    return model, counts


def _hash_all(words: list[bytes]) -> list[int]:
    joined = np.frombuffer(b" ".join(words), np.uint8)
    return hashes(cut(joined, np.array([0, len(joined)]), NOT_SPACE)).tolist()


_SCORED = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
_REST = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text", keep: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each document with n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    kept = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = T.StructType([*kept.schema.fields[:-1], *[T.StructField(n, t) for n, t in _SCORED], T.StructField("rest", _REST)])
    shared = spark.sparkContext.broadcast(model)
    scale = np.log10(model.total + model.different + 1)

    def run(batches):
        m = shared.value
        for batch in batches:
            columns = [[], [], [], []]
            words, times, ends = [], [], [np.zeros(1, np.int64)]
            held = 0
            for _, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                t, texts = tokens(data, offsets, m.index), len(offsets) - 1
                c = np.where(t.place >= 0, m.count[np.maximum(t.place, 0)], 0)
                log_c = np.log10(c + 1.0)
                n = np.bincount(t.row, minlength=texts)
                log_p = m.log_probabilities(t)
                log_p += np.where((t.place < 0) | (t.place >= HEADS), log_c, 0.0)
                columns[0].append(n)
                columns[1].append(np.bincount(t.row[c > 0], minlength=texts))
                columns[2].append(np.bincount(t.row, log_c, texts) - n * scale)
                columns[3].append(np.bincount(t.row, log_p, texts))
                # Tokens outside the dictionary, once for each text, with how often they are there.
                rest = np.flatnonzero(t.place < 0)
                order = rest[np.lexsort((t.key[rest], t.row[rest]))]
                new = np.r_[True, (np.diff(t.row[order]) > 0) | (t.key[order][1:] != t.key[order][:-1])][: len(order)]
                first = np.flatnonzero(new)
                low = t.low.tobytes()
                words += [low[s:e] for s, e in zip(t.start[order[first]].tolist(), t.stop[order[first]].tolist())]
                times.append(np.diff(np.r_[first, len(order)]))
                ends.append(held + np.cumsum(np.bincount(t.row[order[first]], minlength=texts)))
                held += len(first)
            numbers = [np.concatenate(c) if c else np.empty(0) for c in columns]
            if m.total == 0:
                numbers[3] = np.zeros(len(numbers[3]))
            rest = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(np.concatenate([np.empty(0, np.int64), *times]).astype(np.int64))], names=["word", "times"])
            rest = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), rest)
            arrays = [pa.array(x.astype(np.int64 if i < 2 else np.float64)) for i, x in enumerate(numbers)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays, rest], names=schema.fieldNames())

    scored = kept.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialize(spark, scored, "lm-scored")
    rare = scored.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.times")
    found = rare.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("log_c"))
    joined = scored.drop("rest").join(found, "row", "left")
    more, log_c = F.coalesce("more", F.lit(0)), F.coalesce("log_c", F.lit(0.0))
    return joined.select(
        *kept.columns[:-1],
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + log_c).alias("base_score"),
        (F.col("score") + log_c).alias("score"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: held_out (a seventh, by id), its tokens and its base and model scores."""
    divisor, out = HELD_OUT
    held_out = id_remainder("doc_id", divisor) == out
    model, counts = fit(docs, ~held_out)
    return score(docs, model, counts, keep=("doc_id", held_out.alias("held_out")))
