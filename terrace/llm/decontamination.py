"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the benchmark items are put into one generalised
suffix automaton per block of items. Documents stream past it: after each word
the automaton knows the longest benchmark string that ends there, so a length
of ``window`` words or more marks those words as hit, and the states passed
say which items hold them. An item shorter than the window counts when all of
it occurs.

Words are read by the automaton only where a run of them could reach the
shortest length that counts; the run is found from hashes of short word
sequences, which every longer match is made of.

Scale: items are taken in blocks of ``block_words`` words, each broadcast and
applied in one narrow pass over the documents, which carries the merged spans
on to the next block; nothing is shuffled. With several blocks, what a pass
found is written before the next begins, so a worker process has one automaton
at a time, which it builds once and keeps for its further tasks.

Defined results: a null or empty text, or one without words, has no words and
no hits. Null items and items without words have no window. Repeated item ids
count once; items with a null id mark words but are not listed. Repeated
documents each get their own row. An empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import materialize, text_chunks
from terrace.llm.words import ALNUM, HashIndex, cut, hash_of, hashes, mix

WINDOW = 13
COVERAGE = 0.05  # a document is contaminated at this share of hit words
BLOCK_WORDS = 500_000
GRAM = 4


class ItemAutomaton:
    """Generalised suffix automaton over word sequences, with the items of each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for _, words in items:
            coded.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            last = 0
            for code in coded[-1]:
                last = self._extend(last, code)
        self.shortest = min((min(len(c), window) for c in coded if c), default=0)
        self.items: list[list[str]] = [[] for _ in self.next]
        self.whole: dict[int, int] = {}  # state of a short item -> its words
        self.whole_items: dict[int, list[str]] = {}
        self._mark(items, coded)
        # Nearest state up the suffix links, itself included, that is a short item.
        self.short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def _extend(self, last: int, code: int) -> int:
        """Append one word after state ``last``; a string already present adds no state."""
        known = self.next[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, known, code)
        state = self._add(self.length[last] + 1)
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            there = self.next[at][code]
            fits = self.length[there] == self.length[at] + 1
            self.link[state] = there if fits else self._clone(at, there, code)
        return state

    def _add(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, state: int, code: int) -> int:
        """Split off the strings of ``state`` that are no longer than those of ``at`` plus one word."""
        copy = self._add(self.length[at] + 1)
        self.next[copy] = dict(self.next[state])
        self.link[copy] = self.link[state]
        self.link[state] = copy
        while at >= 0 and self.next[at].get(code) == state:
            self.next[at][code] = copy
            at = self.link[at]
        return copy

    def _mark(self, items, coded) -> None:
        """Write each item into the states of its substrings that can be hits."""
        seen = [-1] * len(self.next)
        for number, ((item_id, _), codes) in enumerate(zip(items, coded)):
            state = 0
            for code in codes:
                state = self.next[state][code]
                at = state
                while at > 0 and seen[at] != number:
                    seen[at] = number
                    if item_id is not None:
                        self.items[at].append(item_id)
                    at = self.link[at]
            if 0 < len(codes) < self.window:
                self.whole[state] = len(codes)
                self.whole_items.setdefault(state, []).extend([] if item_id is None else [item_id])

    def walk(self, words: Iterable[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans (word places, end exclusive) of a word sequence, their items and the longest match."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state, length, most = 0, 0, 0
        window, vocabulary = self.window, self.vocabulary
        for place, word in enumerate(words):
            code = vocabulary.get(word)
            if code is None:
                state = length = 0
                continue
            while state and code not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(code)
            if to is None:
                state = length = 0
                continue
            state, length = to, length + 1
            most = max(most, length)
            reach = 0
            if length >= window:
                at = state
                while self.length[self.link[at]] >= window:
                    at = self.link[at]
                items.update(self.items[at])
                reach = window
            at = self.short[state]
            if at == state and length < self.whole[at]:
                at = self.short[self.link[at]]
            while at > 0:  # every short item that ends here
                items.update(self.whole_items[at])
                reach = max(reach, self.whole[at])
                at = self.short[self.link[at]]
            if reach:
                begin = place + 1 - reach
                if spans and begin <= spans[-1][1]:
                    begin = min(spans.pop()[0], begin)
                spans.append((begin, place + 1))
        return _merged(spans), items, most


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


class Matcher:
    """Automaton of a block of items with the hashes that say where to run it."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.automaton = ItemAutomaton(items, window)
        self.gram = min(GRAM, self.automaton.shortest)
        vocabulary = sorted(self.automaton.vocabulary, key=self.automaton.vocabulary.__getitem__)
        self.index = HashIndex(np.array([hash_of(w) for w in vocabulary], np.uint64))
        grams = {tuple(words[i : i + self.gram]) for _, words in items for i in range(len(words) - self.gram + 1)} if self.gram else set()
        codes = np.array([[self.automaton.vocabulary[w] for w in g] for g in grams], np.int64).reshape(len(grams), self.gram)
        self.grams = HashIndex(np.unique(self._keys(codes)))

    @staticmethod
    def _keys(codes: np.ndarray) -> np.ndarray:
        key = np.zeros(len(codes), np.uint64)
        for place in range(codes.shape[1]):
            key = mix(key + codes[:, place].astype(np.uint64) + np.uint64(1))
        return key

    def runs(self, words) -> Iterator[tuple[int, int, int]]:
        """(row, first word, last word + 1) of the runs that are long enough to hold a hit."""
        count = len(words.start) - self.gram + 1
        if count <= 0 or not self.gram:
            return
        codes = self.index.find(hashes(words))
        known = codes >= 0
        possible = np.lib.stride_tricks.sliding_window_view(known, self.gram).all(axis=1)
        row = np.searchsorted(words.first, np.arange(len(words.start)), "right") - 1
        at = np.flatnonzero(possible & (row[:count] == row[self.gram - 1 :]))
        at = at[self.grams.find(self._keys(codes[at[:, None] + np.arange(self.gram)])) >= 0]
        if not len(at):
            return
        breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0)) + 1
        begin, end = at[np.r_[0, breaks]], at[np.r_[breaks - 1, len(at) - 1]] + self.gram
        long = end - begin >= self.automaton.shortest
        yield from zip(row[begin[long]].tolist(), begin[long].tolist(), end[long].tolist())

    def match(self, array: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], set[str], int]]:
        """For each text: its words, hit spans, items found and longest match."""
        for _, data, offsets in text_chunks(array):
            words = cut(data, offsets, ALNUM)
            found: dict[int, tuple[list, set, list]] = {}
            for row, begin, end in self.runs(words):
                low = words.low[words.start[begin] : words.end[end - 1]].tobytes()
                shift = int(words.start[begin])
                pieces = [low[s - shift : e - shift] for s, e in zip(words.start[begin:end].tolist(), words.end[begin:end].tolist())]
                spans, items, most = self.automaton.walk(pieces)
                one = found.setdefault(row, ([], set(), []))
                base = begin - int(words.first[row])
                one[0].extend((s + base, e + base) for s, e in spans)
                one[1].update(items)
                one[2].append(most)
            for row in range(len(offsets) - 1):
                spans, items, most = found.get(row, ((), (), ()))
                yield int(words.first[row + 1] - words.first[row]), _merged(list(spans)), set(items), max(most, default=0)


_held: dict[str, Matcher] = {}  # a worker's automaton: that of the block it last met


def _matcher(key: str, shared, window: int) -> Matcher:
    if key not in _held:
        _held.clear()
        _held[key] = Matcher(shared.value, window)
    return _held[key]


def item_words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    words = cut(data, np.array([0, len(data)]), ALNUM)
    low = words.low.tobytes()
    return [low[s:e] for s, e in zip(words.start.tolist(), words.end.tolist())]


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items as word lists, in blocks of about ``block_words`` words; one block is in memory at a time."""
    block, size = [], 0
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).dropDuplicates()
    for i, t in rows.toLocalIterator():
        words = item_words(t)
        if words:
            block.append((i, words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
    ]
)
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int64()),
    ]
)


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns ``keep`` of each document and a struct ``found``.

    ``found`` has the number of words, the hit spans as word places (end
    exclusive, merged), the ids of the items found and the longest match seen.
    """
    kept = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    return _found(kept, benchmark, "__text", window, block_words).select(*keep, F.col("__found").alias("found"))


def _found(docs: DataFrame, benchmark: DataFrame, text: str, window: int, block_words: int) -> DataFrame:
    """``docs`` with the struct ``__found`` of each text, carried through all blocks of the benchmark."""
    place = docs.schema.fieldNames().index(text)
    out = docs.withColumn("__found", F.lit(None).cast(FOUND))
    schema = out.schema
    spark = docs.sparkSession

    def apply(shared):
        key = uuid.uuid4().hex

        def run(batches):
            matcher = _matcher(key, shared, window)
            for batch in batches:
                texts, before = batch.column(place), batch.column(batch.num_columns - 1).to_pylist()
                rows = []
                for (n, spans, items, most), old in zip(matcher.match(texts), before):
                    if old:
                        spans = _merged(spans + [(s["begin"], s["end"]) for s in old["spans"]])
                        items, most = items | set(old["items"]), max(most, old["longest"])
                    rows.append({"n_words": n, "spans": [{"begin": b, "end": e} for b, e in spans], "items": sorted(items), "longest": most})
                columns = [*batch.columns[:-1], pa.array(rows, _FOUND_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        return run

    blocks = item_blocks(benchmark, block_words=block_words)
    block = next(blocks, [])
    while block is not None:
        shared, block = spark.sparkContext.broadcast(block), next(blocks, None)
        out = out.mapInArrow(apply(shared), schema)
        if block is not None:
            out = materialize(spark, out, "decontamination-found")
            shared.unpersist()
    return out


def _n_hit(found: str) -> Column:
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.begin)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, coverage: float | None = COVERAGE, min_span: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without their contaminated parts, in the columns of ``docs``.

    Documents with hit words at ``coverage`` of their words or more are
    dropped (``None``: none is). From the others, hit spans of ``min_span``
    words or more are cut out of the text, from the first word's start to the
    last word's end (``None``: kept documents stay as they are). Both are judged
    once, on the spans of all blocks of the benchmark together.
    """
    schema = docs.schema
    place = schema.fieldNames().index(text)

    def run(batches):
        for batch in batches:
            columns = list(batch.columns[:-1])
            strings = columns[place].to_pylist()
            for row, found in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                long = [(s["begin"], s["end"]) for s in found["spans"] if s["end"] - s["begin"] >= min_span]
                if long:
                    strings[row] = _without(strings[row], long)
            columns[place] = pa.array(strings, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    out = _found(docs, benchmark, text, window, block_words)
    if coverage is not None:
        n_hit = _n_hit("__found")
        out = out.where((n_hit == 0) | (n_hit < F.lit(coverage) * F.col("__found.n_words")))
    return out.drop("__found") if min_span is None else out.mapInArrow(run, schema)


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode()
    words = cut(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM)
    out, at = [], 0
    for begin, end in spans:
        out.append(raw[at : int(words.start[begin])])
        at = int(words.end[end - 1])
    out.append(raw[at:])
    return b"".join(out).decode()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: words, hit words, items found and the verdict at a twentieth of the words."""
    found = find_spans(docs, benchmark, window=window, block_words=block_words)
    n_hit = _n_hit("found")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("found.n_words"))).alias("contaminated"),
    )
