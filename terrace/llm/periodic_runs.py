"""Periodic runs of words, by maximal pairs.

A run is a stretch of words that repeats with smallest period ``q``, is at
least ``least`` words and ``exponent`` periods long, and can't be extended by
a word on either side. Two occurrences of a stretch of words, ``d`` apart, are a
maximal pair if neither the words before them nor those behind them are equal.
A run of length ``n`` is the maximal pair of its first and its last ``n - q``
words, so the pairs whose distance ``d`` and length ``l`` satisfy
``l + d >= max(least, exponent * d)`` are exactly the runs, found
without extending anything.

Maximal pairs come from the tree of longest-common-prefix intervals, bottom up:
words at which equal stretches begin are an interval, whose list holds them in the order of
the text with the word on their left as class. Where the lists of two children
are merged, the words behind their stretches differ; entries of different classes
have different words before. The smaller list is merged into the larger, and each
of its entries meets its neighbours there only: at such short distances all
occurrences of a stretch lie evenly, one smallest period apart, and of
those between others only the first has another class. An entry pairs with
the neighbour, or with none; that keeps the work at n log n entries.

The intervals come from suffixes sorted by doubling, for the texts of a
batch together. Only suffixes whose beginning occurs twice in their own text
take part in a further round, so ordinary prose leaves after a few words.

Scale: a text is read and answered in one task, without a shuffle; memory is
in proportion to a batch of ``CHUNK_BYTES`` of texts, or to the longest text (about 60 bytes a
word, and 4 a word for each doubling of its longest repeat).

Defined results: null, empty and blank texts have no words and no run. Repeated
rows are answered alike. Empty tables give no rows. Other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import text_chunks

LEAST = 6
EXPONENT = 4
PLANT_SHARE = 10  # of the query: one text in so many is given a periodic end
RUN = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
_ARROW_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_MANY = 8  # lists that grow by more than an eighth at once are sorted anew


def _shortest(least: int, exponent: int) -> int:
    """The shortest pair that any distance allows."""
    return min(max(least, exponent * d) - d for d in range(1, least + 1))


def sorted_suffixes(word: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first words occur again in their text, sorted, and the common prefix of each with the one before it.

    ``word`` numbers the words (different numbers in different texts), ``text``
    is each word's text. Suffixes that share fewer than ``least`` words with
    any other may be missing; the first one and those of a new beginning have prefix 0.
    """
    n = len(word)
    counts = np.bincount(word) if n else np.empty(0, np.int64)
    rank = (np.cumsum(counts) - counts)[word] if n else np.empty(0, np.int64)
    todo = np.flatnonzero(counts[word] > 1) if n else rank
    ranks, at, sure = [], 1, todo
    while len(todo):
        ranks.append(np.append(rank, -1).astype(np.int64 if n >= 1 << 31 else np.int32))
        behind = todo + at
        within = behind < n
        within[within] = text[behind[within]] == text[todo[within]]
        follows = np.zeros(len(todo), np.int64)
        follows[within] = rank[behind[within]] + 1
        order = np.lexsort((follows, rank[todo]))
        todo, follows = todo[order], follows[order]
        old = rank[todo]
        new_old = np.r_[True, old[1:] != old[:-1]]
        new = new_old | np.r_[True, follows[1:] != follows[:-1]]
        place = np.arange(len(todo))
        since = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(new_old, place, 0))
        rank[todo] = old + since
        alone = new & np.r_[new[1:], True]
        at *= 2
        todo = todo[~alone]
        if at <= least:
            sure = todo
    if not len(sure):
        return sure, sure
    found = sure[np.argsort(rank[sure], kind="stable")]
    a, b = found[:-1], found[1:]
    common = np.zeros(len(a), np.int64)
    for level in reversed(range(len(ranks))):
        same = ranks[level][a + common] == ranks[level][b + common]
        common[same] += 1 << level
    return found, np.r_[0, common]


def _pair(i: int, j: int, common: int, left: list[int], least: int, exponent: int, out: dict[tuple[int, int], int]) -> None:
    """Keep the maximal pair (i, j) if its distance fits its length; of equal stretches the smaller period."""
    d = j - i
    if left[i] != left[j] and common + d >= least and common + d >= exponent * d:
        key = (i, common + d)
        if d < out.get(key, d + 1):
            out[key] = d


def _merged(a: list[int], b: list[int], common: int, left: list[int], least: int, exponent: int, out: dict[tuple[int, int], int]) -> list[int]:
    """One list of two children of an interval of ``common`` words, reporting the pairs between them."""
    if len(a) < len(b):
        a, b = b, a
    for p in b:
        k = bisect_left(a, p)
        if k:
            _pair(a[k - 1], p, common, left, least, exponent, out)
        if k < len(a):
            _pair(p, a[k], common, left, least, exponent, out)
    if len(b) * _MANY > len(a):
        a += b
        a.sort()
    else:
        for p in b:
            insort(a, p)
    return a


def runs_of_batch(word: np.ndarray, text: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (first word, length, period) of all runs, in order; words are counted over the batch."""
    shortest = _shortest(least, exponent)
    found, common = sorted_suffixes(word, text, shortest)
    # The left word is the class; at a text's beginning there is none.
    before = np.empty(len(word), np.int64)
    before[1:] = np.where(text[1:] == text[:-1], word[:-1], -1)
    before[:1] = -1
    left, out = before.tolist(), {}
    open_at: list[int] = []  # common prefix and list of each open interval, the longest last
    open_list: list[list[int]] = []
    for p, after in zip(found.tolist(), np.r_[common[1:], 0].tolist() if len(found) else []):
        child = [p]
        while open_at and open_at[-1] > after:
            child = _merged(open_list.pop(), child, open_at.pop(), left, least, exponent, out)
        if after >= shortest:
            if open_at and open_at[-1] == after:
                open_list[-1] = _merged(open_list[-1], child, after, left, least, exponent, out)
            else:
                open_at.append(after)
                open_list.append(child)
    rows = np.array([(i, n, d) for (i, n), d in out.items()], np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, each text with numbers of its own, and each word's text."""
    word, base = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        word += [known.setdefault(w, base + len(known)) for w in words]
        base += len(known)
    return np.array(word, np.int64), np.repeat(np.arange(len(texts)), [len(words) for words in texts])


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words outside any run or in its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _answers(column: pa.Array, least: int, exponent: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    sizes, table, collapsed = [], [], []
    for _, data, offsets in text_chunks(column):
        body = data.tobytes()
        # bytes.split cuts at the same white space as [^\x20\x09-\x0D]+
        texts = [body[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        word, text = _numbered(texts)
        first = np.r_[0, np.cumsum([len(words) for words in texts])]
        runs = runs_of_batch(word, text, least, exponent)
        cut = np.searchsorted(runs[:, 0], first)
        kept = kept_words(len(word), runs)
        for k, words in enumerate(texts):
            if cut[k] < cut[k + 1]:
                words = [words[i] for i in np.flatnonzero(kept[first[k] : first[k + 1]])]
            collapsed.append(b" ".join(words))
        sizes.append(np.diff(cut))
        runs[:, 0] -= first[text[runs[:, 0]]]
        table.append(runs)
    rows = np.concatenate([np.empty((0, 3), np.int64), *table])
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
    values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], fields=list(_ARROW_RUN.value_type))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values), pa.array(collapsed, pa.binary()).cast(pa.string())


def find_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with the runs of each text (start, length, period, by start) and the text without their repetitions.

    The collapsed text keeps a run's first period; its words are joined by one space.
    ``text`` may be replaced by giving its name as one of the results.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name not in (runs, collapsed)])
    passed = list(schema.names)
    schema = schema.add(runs, RUN).add(collapsed, T.StringType())

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            found, short = _answers(batch.column(batch.schema.get_field_index(text)), least, exponent)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in passed], found, short], names=[*passed, runs, collapsed])

    return df.mapInArrow(batches, schema)


def planted(doc_id: str, text: str) -> Column:
    """The text, or for one id in ``PLANT_SHARE`` the text with its end made periodic."""
    h = F.crc32(F.col(doc_id).cast("string"))
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words).cast("long")
    g = F.floor(h / PLANT_SHARE)
    a = F.when(n > 0, g % n)
    p = F.floor((n - a) / (3 + g % 8)) + 1
    given = F.struct(words.alias("w"), a.alias("a"), p.alias("p"))

    def replaced(x: Column) -> Column:
        i = F.sequence(F.lit(0).cast("long"), F.size(x["w"]).cast("long") - 1)
        source = F.transform(i, lambda k: F.when(k < x["a"], k).otherwise(x["a"] + (k - x["a"]) % x["p"]))
        return F.array_join(F.transform(source, lambda k: F.get(x["w"], k.cast("int"))), " ")

    changed = F.transform(F.array(given), lambda x: F.when(F.size(x["w"]) > 0, replaced(x)))
    return F.when(h % PLANT_SHARE == 0, F.coalesce(F.get(changed, 0), F.col(text))).otherwise(F.col(text))


def documents_runs(docs: DataFrame) -> DataFrame:
    """Runs of each document (some given periodic ends): their number, the one with the greatest exponent, and digests.

    A null id gives no periodic end.
    """
    found = find_runs(docs.select("doc_id", planted("doc_id", "text").alias("text")), runs="runs", collapsed="text")
    runs = F.col("runs")
    # Exact comparison of length/period by cross products.
    better = lambda x, y: (x["length"] * y["period"] > y["length"] * x["period"]) | ((x["length"] * y["period"] == y["length"] * x["period"]) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    best = F.aggregate(runs, F.get(runs, 0), lambda y, x: F.when(better(x, y), x).otherwise(y))
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256")).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
