"""Personal data by patterns and by a character-level BiLSTM with CRF transitions.

The patterns (:func:`base`) find e-mail addresses, IP addresses, card numbers and
phone numbers in their usual form. The tagger adds those written otherwise
(``name (at) host dot com``, numbers without a plus, with unusual separators, version 6 addresses):
a bidirectional LSTM over characters scores each character for the tags of its
kinds (beginning, inside, outside), and a CRF's transitions choose the best sequence of tags.

Training is plain numpy (back propagation through time, Adam). The labelled spans are those that the
patterns find in a bounded sample of the documents' own windows (``SAMPLE`` of
each kind, distinct windows in the order of their hashes), and generated ones of the other
spellings, put into sampled windows without personal data; dates, versions, prices and
identifiers in the same windows teach what isn't personal.

Every text is read whole. Each kind needs a digit, an ``@`` or a spelled-out
``at`` or ``dot``; the text within ``REACH`` characters of one is a stretch, and
no other text can hold a span. A stretch is cut into windows of ``WINDOW`` characters that overlap by half.
Each character takes its scores from the window that has most context on both
sides of it, and one Viterbi pass over the whole stretch decides
all its tags together, so a span that crosses windows comes out whole
whatever its length. Spans that touch one of the patterns' are dropped, and
the others must pass an exact check of their kind (:func:`plausible`).

Scale: one narrow pass over the texts; the model (some 100 KB) travels with the
function. The sample shuffles distinct windows only.

Defined results: a null or empty text has no spans. Repeated rows are answered
alike, and copies of a window teach once. Without documents there is nothing to learn or answer. Extra columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import materialize
from terrace.llm.words import mix

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
STEP = 32
REACH = 40
SAMPLE = 200  # windows of each kind
SAMPLE_PLAIN = 700  # windows without personal data
GENERATED = 1_300  # windows with a generated span or a look-alike
HIDDEN = 20
EMBEDDED = 12
EPOCHS = 12
BATCH = 64
RATE = 0.012
AT_ONCE = 160  # windows scored together
SPELLED = re.compile(r"[0-9@]+|[\[({<]\s?at\s?[\])}>]|\bdot\b", re.I)

TAGS = 1 + 2 * len(KINDS)  # outside; beginning and inside of each kind
_LETTERS = 95  # printable ASCII, then: padding, white space, other letters, anything else
_PAD, _BLANK, _LETTER, _OTHER = range(_LETTERS, _LETTERS + 4)
CHARACTERS = _LETTERS + 4

Span = tuple[int, int, int]  # start, kind, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Matches begin where a run of digits begins, which is where the first one can.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_HINT = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start, domain = at, _DOMAIN.match(text, at + 1)
        while domain and start > done and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    values = [int(d) for d in digits]
    doubled = [2 * v - 9 * (v > 4) for v in values[-2::-2]]
    return (sum(values[-1::-2]) + sum(doubled)) % 10 == 0


def _part(digits: str) -> bool:
    short = digits.lstrip("0") or "0"
    return len(short) <= 3 and int(short) <= 255


def base(text: str) -> list[Span]:
    """The patterns' spans by start, then kind."""
    if not _HINT.search(text):
        return []
    found = [(start, 0, end) for start, end in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_part(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


_AT = re.compile(r"@|\bat\b", re.I)
_DOT = re.compile(r"\.|\bdot\b", re.I)


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the tagger found has what its kind needs."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == 0:
        at = _AT.search(text)
        return bool(at and re.search(r"[^\W_]", text[: at.start()]) and _DOT.search(text, at.end()) and re.search(r"[^\W\d_]{2,}\W*$", text))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        four = len(parts) == 4 and all(_part(p) for p in parts)
        return four or bool(re.fullmatch(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}", text))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def codes(text: str) -> np.ndarray:
    """A number under ``CHARACTERS`` for each character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((points > 0x20) & (points < 0x7F), points - 0x20, _LETTER)
    blank = (points == 0x20) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    out[blank] = _BLANK
    out[((points < 0x20) & ~blank) | ((points >= 0x7F) & (points < 0xC0) & ~blank) | (points >= 0x2000)] = _OTHER
    return out.astype(np.int64)


def tags(length: int, spans: Sequence[Span]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for start, kind, end in spans:
        if not out[start:end].any():
            out[start:end] = 2 + 2 * kind
            out[start] = 1 + 2 * kind
    return out


def spans_of(sequence: np.ndarray) -> list[Span]:
    """Spans that a sequence of tags stands for."""
    out: list[Span] = []
    inside = np.flatnonzero(sequence)
    for i in inside.tolist():
        kind, begins = (int(sequence[i]) - 1) // 2, bool(sequence[i] % 2)
        if not begins and out and out[-1][2] == i and out[-1][1] == kind:
            out[-1] = (out[-1][0], kind, i + 1)
        else:
            out.append((i, kind, i + 1))
    return out


# The network. Both directions run side by side: arrays have (direction, window, ...).


class Tagger(NamedTuple):
    embedding: np.ndarray  # CHARACTERS x EMBEDDED
    into: np.ndarray  # 2 x EMBEDDED x 4 HIDDEN: input, forget, output gates and candidates
    again: np.ndarray  # 2 x HIDDEN x 4 HIDDEN
    shift: np.ndarray  # 2 x 1 x 4 HIDDEN
    out: np.ndarray  # 2 x HIDDEN x TAGS
    bias: np.ndarray  # TAGS
    moves: np.ndarray  # TAGS x TAGS, from and to
    first: np.ndarray  # TAGS


def untrained(seed: int = 1) -> Tagger:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: (draw.standard_normal(shape) * shape[-2] ** -0.5).astype(np.float32)
    shift = np.zeros((2, 1, 4 * HIDDEN), np.float32)
    shift[:, :, HIDDEN : 2 * HIDDEN] = 1.0
    zeros = lambda *shape: np.zeros(shape, np.float32)
    return Tagger(normal(CHARACTERS, EMBEDDED) * 3, normal(2, EMBEDDED, 4 * HIDDEN), normal(2, HIDDEN, 4 * HIDDEN), shift, normal(2, HIDDEN, TAGS), zeros(TAGS), zeros(TAGS, TAGS), zeros(TAGS))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _both(x: np.ndarray) -> np.ndarray:
    """(window, place) read forward and backward: (place, 2, window)."""
    return np.stack([x.T, x.T[::-1]], axis=1)


def _run(model: Tagger, x: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
    """Emissions (window, place, tag), and what the way back needs."""
    read, size = _both(x), HIDDEN
    by_character = model.embedding @ model.into + model.shift  # 2 x CHARACTERS x 4 HIDDEN
    hidden = np.zeros((2, len(x), size), np.float32)
    cell, kept, states = hidden, [], []
    for t in range(x.shape[1]):
        z = np.stack([by_character[0][read[t, 0]], by_character[1][read[t, 1]]]) + hidden @ model.again
        gates, candidate = _sigmoid(z[..., : 3 * size]), np.tanh(z[..., 3 * size :])
        before = cell
        cell = gates[..., size : 2 * size] * cell + gates[..., :size] * candidate
        squashed = np.tanh(cell)
        kept.append((gates, candidate, before, squashed, hidden))
        hidden = gates[..., 2 * size :] * squashed
        states.append(hidden)
    states = np.stack(states)  # place, 2, window, HIDDEN
    each = states @ model.out
    return (each[:, 0] + each[::-1, 1] + model.bias).transpose(1, 0, 2), kept, states


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)


def gradients(model: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, Tagger]:
    """Mean negative log-likelihood of the tags ``y``, and its gradient."""
    n, length = x.shape
    emissions, kept, states = _run(model, x)
    # CRF: forward and backward sums.
    ahead = np.empty_like(emissions)
    ahead[:, 0] = emissions[:, 0] + model.first
    for t in range(1, length):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + model.moves, 1) + emissions[:, t]
    back = np.zeros_like(emissions)
    for t in range(length - 2, -1, -1):
        back[:, t] = _log_sum(model.moves + (emissions[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = _log_sum(ahead[:, -1], 1)
    rows, places = np.arange(n)[:, None], np.arange(length)
    scored = emissions[rows, places, y].sum(1) + model.first[y[:, 0]] + model.moves[y[:, :-1], y[:, 1:]].sum(1)
    d_emissions = np.exp(ahead + back - total[:, None, None])
    follow = ahead[:, :-1, :, None] + model.moves + (emissions[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    d_moves = np.exp(follow).sum((0, 1))
    np.add.at(d_moves, (y[:, :-1], y[:, 1:]), -1.0)
    d_emissions[rows, places, y] -= 1.0
    d_first = d_emissions[:, 0].sum(0)
    # The network, from the last place read to the first.
    size = HIDDEN
    d_each = d_emissions.transpose(1, 0, 2)
    d_each = np.stack([d_each, d_each[::-1]], axis=1)  # place, 2, window, TAGS
    d_out = (states.transpose(0, 1, 3, 2) @ d_each).sum(0)
    d_read = d_each @ model.out.transpose(0, 2, 1)
    d_hidden = np.zeros((2, n, size), np.float32)
    d_cell, read = d_hidden, _both(x)
    d_again = np.zeros_like(model.again)
    d_z = np.empty((length, 2, n, 4 * size), np.float32)
    for t in range(length - 1, -1, -1):
        gates, candidate, before, squashed, previous = kept[t]
        d_hidden = d_hidden + d_read[t]
        enter, forget, leave = gates[..., :size], gates[..., size : 2 * size], gates[..., 2 * size :]
        d_cell = d_cell + d_hidden * leave * (1 - squashed**2)
        d_gates = np.concatenate([d_cell * candidate, d_cell * before, d_hidden * squashed], -1) * gates * (1 - gates)
        d_z[t] = np.concatenate([d_gates, d_cell * enter * (1 - candidate**2)], -1)
        d_again += previous.transpose(0, 2, 1) @ d_z[t]
        d_hidden, d_cell = d_z[t] @ model.again.transpose(0, 2, 1), d_cell * forget
    d_by_character = np.zeros((2, CHARACTERS, 4 * size), np.float32)
    for side in (0, 1):
        order = np.argsort(read[:, side], axis=None, kind="stable")
        used, at = np.unique(read[:, side].reshape(-1)[order], return_index=True)
        d_by_character[side][used] = np.add.reduceat(d_z[:, side].reshape(-1, 4 * size)[order], at)
    d_into = model.embedding.T @ d_by_character
    d_embedding = (d_by_character @ model.into.transpose(0, 2, 1)).sum(0)
    d_shift = d_by_character.sum(1, keepdims=True)
    grads = (d_embedding, d_into, d_again, d_shift, d_out, d_emissions.sum((0, 1)), d_moves, d_first)
    return float((total - scored).mean()), Tagger(*[(g / n).astype(np.float32) for g in grads])


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Tagger:
    """A tagger fitted to windows ``x`` with tags ``y``, by Adam with a falling rate."""
    model, draw = untrained(seed), np.random.default_rng(seed)
    mean, square, step = [np.zeros_like(w) for w in model], [np.zeros_like(w) for w in model], 0
    steps = epochs * -(-len(x) // BATCH)
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for at in range(0, len(x), BATCH):
            some = order[at : at + BATCH]
            _, grads = gradients(model, x[some], y[some])
            norm = float(np.sqrt(sum(float((g**2).sum()) for g in grads)))
            scale, step = min(1.0, 5.0 / (norm + 1e-9)), step + 1
            rate = RATE * (1 - 0.9 * step / steps)
            weights = []
            for k, (w, g) in enumerate(zip(model, grads)):
                mean[k] = 0.9 * mean[k] + 0.1 * g * scale
                square[k] = 0.99 * square[k] + 0.01 * (g * scale) ** 2
                weights.append(w - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6))
            model = Tagger(*[w.astype(np.float32) for w in weights])
    return model


def emissions(model: Tagger, x: np.ndarray) -> np.ndarray:
    parts = [_run(model, x[at : at + AT_ONCE])[0] for at in range(0, len(x), AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty((0, WINDOW, TAGS), np.float32)


def viterbi(model: Tagger, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best tags of each row of ``scores`` (row, place, tag), for its first ``lengths`` places."""
    n, most, _ = scores.shape
    best, came = scores[:, 0] + model.first, np.zeros((most, n, TAGS), np.int8)
    for t in range(1, most):
        ways = best[:, :, None] + model.moves
        came[t] = ways.argmax(1)
        going = (t < lengths)[:, None]
        best = np.where(going, ways.max(1) + scores[:, t], best)
    out, rows = np.zeros((n, most), np.int64), np.arange(n)
    now = best.argmax(1)
    for t in range(most - 1, -1, -1):
        inside = t < lengths
        out[inside, t] = now[inside]
        now = np.where(inside, came[t][rows, now], now)
    return out


def decode(model: Tagger, stretches: list[np.ndarray]) -> list[np.ndarray]:
    """The tags of each stretch of character codes, from overlapping windows."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(stretches)
    order = sorted(range(len(stretches)), key=lambda k: len(stretches[k]))
    at = 0
    while at < len(order):
        until, chars = at, 0
        while until < len(order) and (until == at or chars + len(stretches[order[until]]) <= AT_ONCE * WINDOW):
            chars += len(stretches[order[until]])
            until += 1
        group = [stretches[k] for k in order[at:until]]
        lengths = np.array([len(s) for s in group])
        windows = 1 + np.maximum(0, -(-(lengths - WINDOW) // STEP))
        first = np.cumsum(windows) - windows
        x = np.full((int(windows.sum()), WINDOW), _PAD)
        for k, codes_ in enumerate(group):
            for w in range(int(windows[k])):
                piece = codes_[w * STEP : w * STEP + WINDOW]
                x[first[k] + w, : len(piece)] = piece
        scored = emissions(model, x)
        scores = np.zeros((len(group), int(lengths.max()), TAGS), np.float32)
        for k, n in enumerate(lengths.tolist()):
            place = np.arange(n)
            w = np.clip((place - STEP // 2) // STEP, 0, windows[k] - 1)
            scores[k, :n] = scored[first[k] + w, place - w * STEP]
        found = viterbi(model, scores, lengths)
        for k, n in enumerate(lengths.tolist()):
            out[order[at + k]] = found[k, :n]
        at = until
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within ``REACH`` of something that every kind needs."""
    out: list[tuple[int, int]] = []
    for m in SPELLED.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _whole(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without punctuation at its ends, and with the rest of a number or word that it cuts."""
    piece = text[start:end]
    start, end = start + len(piece) - len(piece.lstrip(" \n\t,;:")), end - (len(piece) - len(piece.rstrip(" \n\t.,;:")))
    while 0 < start < end and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while start < end < len(text) and text[end].isalnum() and text[end - 1].isalnum():
        end += 1
    return start, end


def added(texts: Sequence[str], bases: Sequence[list[Span]], model: Tagger) -> list[list[Span]]:
    """The spans that the tagger finds in each text beside the patterns' ones."""
    places = [(row, start, end) for row, text in enumerate(texts) for start, end in stretches(text)]
    decoded = decode(model, [codes(texts[row][start:end]) for row, start, end in places])
    out: list[list[Span]] = [[] for _ in texts]
    for (row, offset, _), sequence in zip(places, decoded):
        for start, kind, end in spans_of(sequence):
            start, end = _whole(texts[row], offset + start, offset + end)
            clear = not any(s < end and start < e for s, _, e in (*bases[row], *out[row][-1:]))
            if clear and plausible(kind, texts[row][start:end]):
                out[row].append((start, kind, end))
    return out


# Labelled windows.


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choices("0123456789", k=n))


def _name(draw: random.Random) -> str:
    return "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9)))


def _card_number(draw: random.Random) -> str:
    body = draw.choice("3456") + _digits(draw, draw.choice((12, 14, 14, 14)))
    return next(body + d for d in "0123456789" if luhn(body + d))


def spelled_otherwise(kind: int, draw: random.Random) -> str:
    """Personal data of a kind as the patterns don't expect it."""
    if kind == 0:
        at = draw.choice((" (at) ", " [at] ", " at ", "(at)", " @ ", "[at]", " {at} ", " AT "))
        dot = draw.choice((" (dot) ", " [dot] ", " dot ", "(dot)", ".", " . ", "[.]", " DOT ")) if at != " at " else " dot "
        local = draw.choice((_name(draw), f"{_name(draw)}.{_name(draw)}", f"{_name(draw)}{dot}{_name(draw)}", f"{_name(draw)}.{_digits(draw, 2)}"))
        host = draw.choice((_name(draw), f"{_name(draw)}{_digits(draw, 1)}", f"{_name(draw)}{dot}{_name(draw)}"))
        return f"{local}{at}{host}{dot}{draw.choice(('com', 'org', 'net', 'de', 'fr', 'edu', 'io'))}"
    if kind == 1:
        if draw.random() < 0.4:
            groups = ["".join(draw.choices("0123456789abcdef", k=draw.randint(1, 4))) for _ in range(8)]
            cut = draw.randint(2, 5)
            return ":".join(groups) if draw.random() < 0.5 else ":".join(groups[:cut]) + "::" + groups[-1]
        return draw.choice(("[.]", " . ", "(.)", " dot ", "[dot]")).join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == 2:
        number = _card_number(draw)
        return draw.choice((".", "/", "  ", "_", " - ")).join(number[i : i + 4] for i in range(0, len(number), 4))
    area, middle, last = _digits(draw, 3), _digits(draw, 3), _digits(draw, 4)
    return draw.choice((f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"1-{area}-{middle}-{last}", f"00{draw.randint(1, 99)} {area} {middle}{last}", f"0{area} {middle}{last}", f"({area}){middle}-{last}", f"+{draw.randint(1, 99)}/{area}/{middle}{last}"))


def usual(kind: int, draw: random.Random) -> str:
    """Personal data as the patterns expect it, which they miss where it runs into other numbers."""
    if kind == 0:
        return f"{_name(draw)}.{_digits(draw, 2)}@{_name(draw)}{_digits(draw, 1)}.{_name(draw)}.{draw.choice(('com', 'org', 'net'))}"
    if kind == 1:
        return ".".join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == 2:
        number = _card_number(draw)
        return draw.choice(("", "", " ", "-")).join(number[i : i + 4] for i in range(0, len(number), 4))
    return f"+{draw.randint(1, 99)} ({_digits(draw, 3)}) {_digits(draw, 3)}-{_digits(draw, 4)}"


def look_alike(draw: random.Random) -> str:
    """Something with digits or an at that is no personal data."""
    d = lambda n: _digits(draw, n)
    made = (
        f"{draw.randint(1900, 2099)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}",
        f"{draw.randint(1, 28)}.{draw.randint(1, 12)}.{draw.randint(1900, 2099)}",
        f"{draw.randint(1900, 2099)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d} {draw.randint(0, 23):02d}:{d(2)}:{d(2)}",
        f"{draw.randint(0, 23):02d}:{draw.randint(0, 59):02d}",
        f"{draw.randint(0, 20)}.{draw.randint(0, 30)}.{draw.randint(0, 9)}",
        f"{draw.randint(1, 99)}.{d(2)} EUR",
        f"${draw.randint(1, 999)},{d(3)}.{d(2)}",
        f"{draw.randint(1800, 2030)}-{draw.randint(1800, 2030)}",
        f"{draw.randint(1800, 2030)}",
        d(draw.randint(1, 6)),
        d(draw.choice((7, 8, 9, 10, 12, 15, 18, 20))),
        "".join(draw.choices("0123456789abcdef", k=draw.choice((16, 20, 32, 40)))),
        "AKIA" + "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
        f"ISBN 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}",
        f"{_name(draw)} at {_name(draw)} {_name(draw)}",
        f"the dot {_name(draw)}",
        f"@{_name(draw)}",
        f"{d(3)}/{d(3)}",
        f"version {draw.randint(1, 9)}.{draw.randint(0, 9)}",
        f"{d(2)} - {d(2)}, {d(3)}",
        f"id={d(draw.randint(5, 11))}",
        f"{d(1)},{d(3)},{d(3)},{d(3)}",
    )
    return draw.choice(made)


def labelled_windows(found: Sequence[tuple[str, list[Span]]], plain: Sequence[str], seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Character codes and tags of the sampled windows, and of generated spans in windows without personal data."""
    draw = random.Random(seed)
    examples = [*found, *((text, []) for text in plain)]
    for i in range(GENERATED if plain else 0):
        text, kind = draw.choice(plain), i % (len(KINDS) + 2)
        made = [(kind, spelled_otherwise(kind, draw))] if kind < len(KINDS) else [(None, look_alike(draw))]
        if draw.random() < 0.3:  # beside another, so that one pattern takes both or neither
            other = draw.randrange(len(KINDS))
            made.insert(draw.randint(0, 1), (other, usual(other, draw)))
            made = [(k, usual(k, draw) if k is not None and draw.random() < 0.5 else piece) for k, piece in made]
        size = sum(len(piece) + 1 for _, piece in made)
        start = draw.choice([m.end() for m in re.finditer(r"\s", text[: max(1, WINDOW - size)])] or [0])
        whole, spans = text[:start], []
        for k, piece in made:
            spans += [] if k is None else [(len(whole), k, len(whole) + len(piece))]
            whole += piece + draw.choice((" ", " ", " ", ". ", ", "))
        examples.append((whole + text[start:], spans))
    x, y = np.full((len(examples), WINDOW), _PAD), np.zeros((len(examples), WINDOW), np.int64)
    for k, (text, spans) in enumerate(examples):
        n = min(len(text), WINDOW)
        x[k, :n] = codes(text)[:n]
        y[k, :n] = tags(len(text), spans)[:n]
    return x, y


def _windows_of(text: str) -> Iterator[tuple[int, str, list[int]]]:
    """(kind or ``len(KINDS)`` for none, window, flat spans) of a text's labelled windows."""
    spans = base(text)

    def window(start: int) -> tuple[str, list[int]]:
        piece = text[start : start + WINDOW]
        inside = [(max(s, start) - start, kind, min(e, start + WINDOW) - start) for s, kind, e in spans if s < start + WINDOW and e > start]
        return piece, [v for span in inside for v in span]

    for n, (s, kind, e) in enumerate(spans):
        room = max(0, WINDOW - (e - s))
        yield kind, *window(max(0, s - (s * 31 + n * 7) % (room + 1)))
    places = [start for start, _ in stretches(text)]
    if text:
        places.append(int(mix(np.array([len(text)], np.uint64))[0] % np.uint64(max(1, len(text) - WINDOW))))
    for start in places:
        piece, inside = window(start)
        if not inside:
            yield len(KINDS), piece, []


def _decoded(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def sample(docs: DataFrame, text: str = "text") -> tuple[list[tuple[str, list[Span]]], list[str]]:
    """Distinct windows with the patterns' spans, and windows without any; bounded by ``SAMPLE`` and ``SAMPLE_PLAIN``."""
    schema = "kind int, piece string, spans array<int>"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [w for t in _decoded(batch.column(0)) for w in _windows_of(t)]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(pa.int32()))], names=["kind", "piece", "spans"])

    every = docs.select(text).mapInArrow(windows, schema).groupBy("kind", "piece").agg(F.min("spans").alias("spans"))
    every = materialize(docs.sparkSession, every.withColumn("key", F.xxhash64("piece")), "personal-windows")
    parts = [every.where(F.col("kind") == k).orderBy("key", "piece").limit(SAMPLE if k < len(KINDS) else SAMPLE_PLAIN) for k in range(len(KINDS) + 1)]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionAll(part)
    rows = sorted((r["kind"], r["key"], r["piece"], r["spans"]) for r in chosen.collect())
    found = [(piece, [tuple(spans[i : i + 3]) for i in range(0, len(spans), 3)]) for kind, _, piece, spans in rows if kind < len(KINDS)]
    return found, [piece for kind, _, piece, _ in rows if kind == len(KINDS)]


def learn(docs: DataFrame, text: str = "text") -> Tagger:
    """A tagger from a bounded sample of the documents."""
    found, plain = sample(docs, text)
    x, y = labelled_windows(found, plain)
    return train(x, y) if len(x) else untrained()


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
TEXTS_AT_ONCE = 512


def find(df: DataFrame, model: Tagger, text: str = "text", patterns: str = "pattern_spans", others: str = "added_spans") -> DataFrame:
    """``df`` (without ``text``) and the spans of each text: the patterns' and the tagger's, by start."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in (text, patterns, others)])
    passed = list(schema.names)
    schema = schema.add(patterns, SPAN).add(others, SPAN)

    def told(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row] for row in spans], _ARROW_SPAN)

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for at in range(0, table.num_rows, TEXTS_AT_ONCE):
                batch = table.slice(at, TEXTS_AT_ONCE)
                texts = _decoded(batch.column(batch.schema.get_field_index(text)))
                bases = [base(t) for t in texts]
                other = added(texts, bases, model)
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in passed], told(bases), told(other)], names=[*passed, patterns, others])

    return df.mapInArrow(batches, schema)


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def documents_spans(docs: DataFrame) -> DataFrame:
    """Number of spans of each kind that the patterns find, their digest, and all spans with the tagger's."""
    rows = docs.select("doc_id", "text")
    found = find(rows, learn(rows))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    order = {kind: str(i) for i, kind in enumerate(KINDS)}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    keyed = F.transform(F.concat("pattern_spans", "added_spans"), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    counts = [F.size(F.filter("pattern_spans", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("pattern_spans")), 256).alias("base_sha256"), listed(F.array_sort(keyed)).alias("spans"), F.size("added_spans").cast("long").alias("n_added"))
