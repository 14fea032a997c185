"""Language identification by cross-parsing entropy.

For each language the labelled text of a bounded sample goes into a suffix
automaton of its bytes. A text is parsed from left to right into the longest
phrases that occur in a language's sample; the number of phrases, normalised
by the sample's size (phrases x log2(sample bytes) / bytes of text), estimates
the cross entropy, and the language that needs the fewest normalised phrases
wins. A sample under half the largest one is normalised as the largest, so
that a language of which a few bytes are known isn't the cheapest for any text.

Only letters count: A-Z and Latin-1 capitals are lower-cased, every run of
other ASCII bytes is one separator, and bytes beyond ASCII stay as they are.
Parsing starts anew every ``WINDOW`` bytes, so that all windows of a batch are
parsed side by side on a dense transition table, whatever the text's length.

Scale: every label is learned, each from at most ``sample_bytes`` bytes of its
own. The transitions of all languages are broadcast (well under 1 MB for each
language); the dense tables stand in a worker up to ``DENSE_BYTES``, and those
beyond are laid out anew for each batch, one at a time. The scoring is one
narrow pass.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if nothing was learned. The score is 1 - least / second least normalised
phrases (1 when only one language is known), so a tie has score 0 and goes to
the first language in code point order. Labelled rows with null text or
language teach nothing. Repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import id_remainder, text_chunks
from terrace.llm.words import SEPARATOR, letters

UNDETERMINED = "und"
SAMPLE_BYTES = 24_000  # of each language
SAMPLE_SPARSE = 32  # a text is read for so many bytes of its language's share, to fill it from short texts too
SAMPLE_TEXT_BYTES = 4_000  # longer texts are taken, by their beginnings, only where a language has no others
DENSE_BYTES = 128 << 20  # of tables that a process keeps
WINDOW = 256
HELD_OUT = 5
HAS_LETTER = r"\p{L}"


def _automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for byte in text:
        state = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and byte not in nxt[at]:
            nxt[at][byte] = state
            at = link[at]
        if at >= 0:
            there = nxt[at][byte]
            if length[there] == length[at] + 1:
                link[state] = there
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                while at >= 0 and nxt[at].get(byte) == there:
                    nxt[at][byte] = copy
                    at = link[at]
                link[there] = link[state] = copy
        last = state
    return nxt


_BEGINS = 1 << 30  # flag: this byte begins a phrase


class Parser:
    """Transitions of all languages over the bytes that the samples hold."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        seen = sorted(set(b"".join(samples.values())))
        # Column 0 stands for bytes that no sample holds, the last one for padding.
        self.symbol, self.columns = np.zeros(256, np.int32), len(seen) + 2  # byte -> column
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.scale = np.array([np.log2(max(2, len(samples[x]))) for x in self.languages])  # bits for a phrase's place
        self.states: list[int] = []
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []  # state * columns + symbol, next state
        for language in self.languages:
            nxt = _automaton(samples[language])
            state = np.repeat(np.arange(len(nxt), dtype=np.int32), [len(to) for to in nxt])
            byte = np.array([x for to in nxt for x in to], np.uint8)
            self.states.append(len(nxt))
            self.steps.append((state * self.columns + self.symbol[byte], np.array([x for to in nxt for x in to.values()], np.int32)))
        self.dense: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"dense": {}}

    @staticmethod
    def learn(samples: dict[str, bytes]) -> Parser:
        return Parser(samples)

    def table(self, number: int) -> np.ndarray:
        """Of a language: state * columns + symbol -> next state * columns, perhaps with _BEGINS."""
        if number in self.dense:
            return self.dense[number]
        columns, states, (place, to) = self.columns, self.states[number], self.steps[number]
        table = np.full(states * columns, -1, np.int32)
        table[place] = to
        table = table.reshape(states, columns)
        # A byte begins a phrase at the start and where there's no way on (a
        # byte unknown to the language is a phrase by itself).
        start = np.where(table[0] >= 0, table[0], 0) * columns + _BEGINS
        out = np.where(table >= 0, table * columns, start).astype(np.int32)
        out[0] = start
        out[:, columns - 1] = np.arange(states) * columns
        out = out.ravel()
        if sum(x.nbytes for x in self.dense.values()) + out.nbytes <= DENSE_BYTES:
            self.dense[number] = out
        return out

    def entropies(self, array: pa.Array) -> np.ndarray:
        """Bits a byte for each text (rows) and language (columns); infinite for texts without bytes."""
        out = np.full((len(array), len(self.languages)), np.inf)
        for at, data, offsets in text_chunks(array):
            text, offsets = letters(data, offsets)
            size = np.diff(offsets)
            windows = -(-size // WINDOW)
            if not windows.sum():
                continue
            row = np.repeat(np.arange(len(size)), windows)
            first = np.cumsum(windows) - windows
            begin = offsets[row] + (np.arange(len(row)) - first[row]) * WINDOW
            length = np.minimum(offsets[row + 1] - begin, WINDOW)
            # One row for each place in the windows, so that a step reads one row.
            coded = np.full((WINDOW, len(row)), self.columns - 1, np.int32)
            symbols = self.symbol[text]
            for place in range(int(length.max())):
                inside = length > place
                coded[place, inside] = symbols[begin[inside] + place]
            for number in range(len(self.languages)):
                table = self.table(number)
                state, phrases = np.zeros(len(row), np.int32), np.zeros(len(row), np.int64)
                for place in range(int(length.max())):
                    step = table[state + coded[place]]
                    phrases += step >> 30
                    state = step & (_BEGINS - 1)
                bits = np.bincount(row, phrases, len(size)) * self.scale[number]
                some = size > 0
                out[at : at + len(size), number][some] = bits[some] / size[some]
        return out

    def costs(self, array: pa.Array) -> np.ndarray:
        """The entropies, with a phrase of a sample under half the largest one at the largest one's price.

        Else a sample of a few bytes would price a phrase, and so any byte,
        lower than a byte costs unparsed, and win every text.
        """
        most = self.scale.max(initial=1.0)
        return self.entropies(array) * (np.where(self.scale >= most - 1, self.scale, most) / self.scale)

    def predict(self, array: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(array), np.zeros(len(array))
        bits = self.costs(array)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        if len(self.languages) == 1:
            score = np.where(np.isfinite(least), 1.0, 0.0)
        else:
            second = np.partition(bits, 1, axis=1)[:, 1]
            with np.errstate(invalid="ignore"):
                score = np.where(np.isfinite(least), 1 - least / second, 0.0)
        names = [self.languages[b] if np.isfinite(v) else UNDETERMINED for b, v in zip(best, least)]
        return names, score


def learn(docs: DataFrame, teaches: Column, text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES) -> Parser:
    """The parser of the labelled rows for which ``teaches`` holds, with every language among them.

    The sample of a language is its first texts in the order of their hash,
    whole, up to ``sample_bytes``; only a few hundred texts of each reach the
    driver.
    """
    labelled = docs.where(teaches & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(HAS_LETTER))
    rows = labelled.select(F.col(lang).alias("l"), F.xxhash64(F.lit(HELD_OUT), F.col(text)).alias("h"), F.col(text).alias("t"))
    most = min(SAMPLE_TEXT_BYTES, max(sample_bytes // 2, 1))
    fits = F.octet_length("t") <= most
    counted = rows.groupBy("l").agg(F.approx_count_distinct(F.when(fits, F.col("h"))).alias("fit"), F.approx_count_distinct("h").alias("all")).collect()
    if not counted:
        return Parser.learn({})
    # The chance of a text follows its language's distinct texts, so that a few
    # hundred of each are read; copies share their hash and count once.
    chance = F.create_map(*[F.lit(v) for r in counted for v in (r["l"], min(1.0, sample_bytes / SAMPLE_SPARSE / (r["fit"] or r["all"])))])
    only_long = [r["l"] for r in counted if not r["fit"]]
    taken = fits | F.col("l").isin(only_long) if only_long else fits
    rows = rows.where(taken & (F.pmod("h", F.lit(1 << 31)) < F.element_at(chance, F.col("l")) * F.lit(float(1 << 31))))
    rows = rows.select("l", "h", F.substring("t", 1, most).alias("t"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for l, x, t in rows.groupBy("l", "h").agg(F.min("t").alias("t")).toLocalIterator():
        texts.setdefault(l, []).append((x, t))
    lines: dict[str, list[list[str]]] = {}
    for name in sorted(texts):
        room, lines[name] = sample_bytes, []
        for _, t in sorted(texts[name]):
            if len(t.encode()) < room:
                lines[name].append(t.split("\n"))
                room -= len(t.encode()) + 1
    return Parser.learn(_samples(_own_lines(lines)))


def _samples(lines: dict[str, list[list[str]]]) -> dict[str, bytes]:
    """Each language's lines, normalised, with a separator after each."""
    out = {}
    for name, texts in lines.items():
        raw = "".join(line + "\n" for text in texts for line in text).encode()
        sample = letters(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tobytes()
        if sample.strip(bytes([SEPARATOR])):
            out[name] = sample
    return out


def _own_lines(lines: dict[str, list[list[str]]]) -> dict[str, list[list[str]]]:
    """The sample without lines in another language, such as licences and quotations.

    The texts are halved; a line stays if its own language parses it with the
    fewest normalised phrases of the other half.
    """
    halves = [{name: texts[side::2] for name, texts in lines.items()} for side in (0, 1)]
    parsers = [Parser.learn(_samples(half)) for half in halves]
    out: dict[str, list[list[str]]] = {name: [] for name in lines}
    for half, parser in zip(halves, reversed(parsers)):
        every = [line for texts in half.values() for text in texts for line in text]
        best = iter(parser.costs(pa.array(every, pa.string())).argmin(axis=1).tolist() if len(parser.languages) > 1 else [0] * len(every))
        for name, texts in half.items():
            for text in texts:
                own = [(line, next(best)) for line in text]
                if name in parser.languages and len(parser.languages) > 1:
                    text = [line for line, b in own if parser.languages[b] == name or not line.strip()]
                out[name].append(text)
    return {name: texts if _samples({name: texts}) else lines[name] for name, texts in out.items()}


def predict(docs: DataFrame, parser: Parser, text: str = "text", keep: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` of each document."""
    kept = docs.select(*keep, F.coalesce(F.col(text).rlike(HAS_LETTER), F.lit(False)).alias("__letters"), F.col(text).alias("__text"))
    schema = T.StructType([*kept.schema.fields[:-2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    def run(batches):
        for batch in batches:
            names, score = shared.value.predict(batch.column(batch.num_columns - 1))
            for row, known in enumerate(batch.column(batch.num_columns - 2).to_pylist()):
                if not known:
                    names[row], score[row] = UNDETERMINED, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names, pa.string()), pa.array(score)], names=schema.fieldNames())

    return kept.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, parser: Parser, text: str = "text") -> DataFrame:
    """The documents (all columns) whose language can be told: not ``und``, and no tie between languages."""
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    def run(batches):
        for batch in batches:
            names, score = shared.value.predict(batch.column(place))
            keep = [name != UNDETERMINED and s > 0 for name, s in zip(names, score)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.where(F.col(text).rlike(HAS_LETTER)).mapInArrow(run, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: held_out (a fifth, by id), the predicted language and the score."""
    remainder = id_remainder("doc_id", HELD_OUT)
    parser = learn(docs, remainder != 0)
    return predict(docs, parser, keep=("doc_id", (remainder == 0).alias("held_out")))
