"""Token ids packed into rows of equal length by best-fit-decreasing.

Every text becomes the ids of a public byte-pair vocabulary and an end id.
Longer documents are cut into pieces of a row's length, and what is left of
them; pieces are placed from the longest to the shortest, each in the open row
with the least room that holds it, which a segment tree over the rooms finds
in logarithmic time. A row is written with its ids (and padding) as
little-endian integers, its cumulative segment lengths, its positions, which
begin anew at every segment, and the document and part of each segment, so
that every document can be put together again (:func:`unpack`).

Scale: each task packs the rows it reads in pools of ``POOL_TOKENS`` tokens,
so nothing is shuffled and memory is bounded; a pool holds hundreds of rows,
and only its last ones have much padding. The vocabulary is read by the driver
and broadcast (a file of fixed size).

Defined results: a null or empty text is its end id alone. Null ids stay null
in the segments. Repeated rows are packed as often as they are there. An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections import deque
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_ID = 50256  # free in the rank file; also fills a row's rest
LENGTH = 2048
POOL_TOKENS = 2_000_000
LONG_SPACE = 10_000  # characters; the matcher takes hundreds of thousands
# Fixed value of the vocabulary: the pattern that splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("terrace", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


# White space as the pattern's \\s has it.
_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_LONG_SPACE = re.compile(_SPACE + "{%d,}" % LONG_SPACE)


def encode(coder: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text of any length.

    The pattern's matcher needs stack for each character of white space, so
    long runs of it are cut out first, as the pattern does: all of a run but the last
    character, which belongs to what follows, is one piece.
    """
    ids, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        last = run.end() - (run.end() < len(text))
        ids += coder.encode_ordinary(text[at : run.start()])
        ids += coder._core_bpe.encode_single_piece(text[run.start() : last].encode())
        at = last
    return ids + coder.encode_ordinary(text[at:])


class RoomTree:
    """Open rows by the room they have left; finds the least room that is large enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[deque[int]] = [deque() for _ in range(most + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(row, room) of the tightest row with room for ``least``, taken out; the oldest of equal ones."""
        count, at = self.count, least + self.leaves
        while not count[at]:
            # Up to the first subtree on the right that holds a row.
            while at & 1 or not count[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return self.rows[room].popleft(), room


class Piece(NamedTuple):
    document: object
    part: int
    ids: np.ndarray


def pack(pieces: list[Piece], length: int) -> list[list[Piece]]:
    """Best-fit-decreasing: the pieces (none longer than ``length``) of each row."""
    rows: list[list[Piece]] = []
    tree = RoomTree(length)
    for piece in sorted(pieces, key=lambda p: -len(p.ids)):
        size = len(piece.ids)
        found = tree.take(size)
        if found is None:
            row, room = len(rows), length
            rows.append([])
        else:
            row, room = found
        rows[row].append(piece)
        if room > size:
            tree.put(row, room - size)
    return rows


def _schema(doc_type: T.DataType) -> T.StructType:
    segment = T.StructType([T.StructField("doc_id", doc_type), T.StructField("part", T.IntegerType())])
    return T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("row", T.LongType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("positions", T.BinaryType()),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField("segments", T.ArrayType(segment)),
        ]
    )


def _write(rows: list[list[Piece]], first: int, shard: int, length: int, kind: np.dtype, end_id: int, doc_type: pa.DataType) -> pa.RecordBatch:
    ids, positions, used, lengths, documents, parts = [], [], [], [np.zeros(1, np.int64)], [], []
    cumulative = []
    for row in rows:
        sizes = np.array([len(p.ids) for p in row])
        ends = np.r_[0, np.cumsum(sizes)]
        body = np.full(length, end_id, kind)
        body[: ends[-1]] = np.concatenate([p.ids for p in row])
        place = np.zeros(length, kind)
        place[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        ids.append(body.tobytes())
        positions.append(place.tobytes())
        used.append(ends[-1])
        cumulative.append(ends)
        documents += [p.document for p in row]
        parts += [p.part for p in row]
        lengths.append(np.array([len(row)]))
    bounds = np.cumsum(np.concatenate(lengths)).astype(np.int32)
    cu_bounds = np.r_[0, np.cumsum([len(c) for c in cumulative])].astype(np.int32)
    segments = pa.StructArray.from_arrays([pa.array(documents, doc_type), pa.array(parts, pa.int32())], names=["doc_id", "part"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), shard, np.int32)),
            pa.array(np.arange(first, first + len(rows), dtype=np.int64)),
            pa.array(np.array(used, np.int32)),
            pa.array(ids, pa.binary()),
            pa.array(positions, pa.binary()),
            pa.ListArray.from_arrays(pa.array(cu_bounds), pa.array(np.concatenate(cumulative).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(bounds), segments),
        ],
        names=["shard", "row", "n_tokens", "ids", "positions", "cu_seqlens", "segments"],
    )


def id_kind(ranks: dict[bytes, int], end_id: int, length: int) -> np.dtype:
    """The narrowest of two little-endian integers that holds every id and position."""
    return np.dtype("<u2" if max(max(ranks.values()), end_id, length) < 1 << 16 else "<u4")


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = LENGTH, pool_tokens: int = POOL_TOKENS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``length`` ids: shard, row, n_tokens, ids, positions, cu_seqlens and segments (doc_id, part)."""
    ranks = read_ranks(vocabulary)
    kind = id_kind(ranks, end_id, length)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        coder = encoding(shared.value)
        shard, written = TaskContext.get().partitionId(), 0
        pool: list[Piece] = []
        size, doc_type = 0, None
        for batch in batches:
            doc_type = batch.column(0).type
            for document, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(coder, body.as_py()), end_id], kind)
                for part, at in enumerate(range(0, len(ids), length)):
                    pool.append(Piece(document, part, ids[at : at + length]))
                size += len(ids)
                if size >= pool_tokens:
                    rows = pack(pool, length)
                    yield _write(rows, written, shard, length, kind, end_id, doc_type)
                    written, pool, size = written + len(rows), [], 0
        if pool:
            yield _write(pack(pool, length), written, shard, length, kind, end_id, doc_type)

    return kept.mapInArrow(run, _schema(kept.schema["doc_id"].dataType))


def unpack(rows, ranks: dict[bytes, int], end_id: int = END_ID, length: int = LENGTH) -> list[tuple[object, str]]:
    """(doc_id, text) of every document in collected packed rows: the way back, for tests and readers of small samples.

    Parts of one document are told apart by their order in the rows, so ids must be unique.
    """
    kind, ids_of = id_kind(ranks, end_id, length), {}
    for row in rows:
        ids = np.frombuffer(row["ids"], kind)
        for segment, begin, end in zip(row["segments"], row["cu_seqlens"], row["cu_seqlens"][1:]):
            ids_of.setdefault(segment["doc_id"], {})[segment["part"]] = ids[begin:end]
    coder, out = encoding(ranks), []
    for document, parts in ids_of.items():
        ids = np.concatenate([parts[p] for p in sorted(parts)])
        out.append((document, coder.decode(ids[:-1].tolist())))
    return out
