"""Byte-level BPE by dynamic programming over byte prefixes.

Merging the lowest rank first has a property that needs no merging at all: a sequence of tokens is
the encoding of its bytes exactly when each two neighbours, merged alone, stay these two
tokens. So each prefix of a byte string has one valid last token: the one token at its end that
fits the last token of the prefix before it. ``Prefixes`` stores these last tokens. With them an append only
looks at the new bytes, an edit is encoded anew only until as many last tokens agree with the
old ones as the longest token has bytes, and words walked in sorted order share their prefixes.

Whether two tokens fit is decided on their edges: the tokens that stood at the right end of the first
and at the left end of the second while these were built, in the order of their ranks. The pair is
broken if some edge pair has a merge of its own that comes before either edge's next merge.

A token that merging its own bytes does not give (none in the public files) is used only where
a whole piece equals it, as the public libraries do.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces of a text that are encoded together; a longer text is taken in so many at a time.
PIECES = 200_000
#: Pieces and pairs that a worker remembers are forgotten beyond so many bytes, and so many pairs.
REMEMBERED_BYTES = 96 << 20
REMEMBERED_PAIRS = 1_000_000
#: Results go back to Spark in batches of about so many bytes.
BATCH_BYTES = 4 << 20
_NEVER = 1 << 62


def _merged(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """``data`` merged by ranks lower than ``below``, lowest first and leftmost first."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


@dataclass
class Vocabulary:
    """``ranks`` of byte strings (all 256 single bytes among them), ids and priorities at once.

    Its size is that of a vocabulary file, so it is broadcast.
    """

    ranks: dict[bytes, int]
    pieces: dict[int, bytes] = field(init=False)
    left: dict[bytes, list] = field(init=False)
    right: dict[bytes, list] = field(init=False)
    longer: dict[bytes, set[int]] = field(init=False)
    longest: int = field(init=False)
    encoders: dict[str, Encoder] = field(init=False, default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.pieces = {rank: token for token, rank in self.ranks.items()}
        if len(self.pieces) < len(self.ranks):
            raise ValueError("two tokens share a rank")
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.left, self.right = {}, {}
        for token in sorted(self.ranks, key=len):
            here = (token, self.ranks[token])
            if len(token) == 1:
                self.left[token] = self.right[token] = [here]
                continue
            halves = _merged(token, self.ranks, self.ranks[token])
            if len(halves) == 2 and all(h in self.left for h in halves):
                first, second = halves
                if max(self.ranks[h] if len(h) > 1 else -1 for h in halves) > self.ranks[token]:
                    raise ValueError(f"token {token!r} ranks before one that it is made of")
                self.left[token] = [*self.left[first], here]
                self.right[token] = [*self.right[second], here]
        self.longer = {}
        for token in self.left:
            if len(token) > 2:
                self.longer.setdefault(token[-3:], set()).add(len(token))
        self.longest = max(map(len, self.left))

    def sizes(self, end: bytes) -> tuple[int, ...]:
        """Sizes, longest first, of the tokens that end a prefix with the last (three, if it has them) bytes ``end``."""
        longer = sorted(self.longer.get(end, ()), reverse=True)
        return (*longer, *([2] if len(end) > 1 and end[-2:] in self.left else []), 1)

    def fits(self, first: bytes, second: bytes) -> bool:
        """Whether merging the bytes of both tokens leaves just these two."""
        edges, others, ranks = self.right[first], self.left[second], self.ranks
        i = j = 0
        while True:
            grows = edges[i + 1][1] if i + 1 < len(edges) else _NEVER
            other = others[j + 1][1] if j + 1 < len(others) else _NEVER
            across = ranks.get(edges[i][0] + others[j][0], _NEVER)
            if across < grows and across <= other:
                return False
            if grows == other == _NEVER:
                return True
            if grows <= other:
                i += 1
            else:
                j += 1


def load_vocabulary(path: str) -> Vocabulary:
    """A file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


@dataclass
class Known:
    """What was found out about pairs of tokens and about ends of prefixes, for reuse."""

    fitting: dict = field(default_factory=dict)
    ending: dict = field(default_factory=dict)


class Prefixes:
    """The last token of each prefix of a byte string that grows, shrinks and is edited."""

    def __init__(self, vocabulary: Vocabulary, known: Known | None = None):
        self.vocabulary = vocabulary
        self.known = known or Known()
        self.data = b""
        self.last: list[bytes] = [b""]

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        self.data = self.data[:size]
        del self.last[size + 1:]

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self._walk(start)

    def _walk(self, start: int, old: list[bytes] | None = None) -> int:
        """Last tokens from ``start`` on; ends early, with its number of steps, where as many as
        matter agree with the ``old`` ones."""
        data, last, fitting, ending, vocabulary = self.data, self.last, self.known.fitting, self.known.ending, self.vocabulary
        left, fits, longest = vocabulary.left, vocabulary.fits, vocabulary.longest
        same = 0
        for end in range(start + 1, len(data) + 1):
            tail = data[end - 3:end] if end > 2 else data[:end]
            sizes = ending.get(tail)
            if sizes is None:
                sizes = ending[tail] = vocabulary.sizes(tail)
            for size in sizes:
                if size > end:
                    continue
                token = data[end - size:end]
                if token not in left:
                    continue
                if size == end:
                    break
                pair = last[end - size], token
                good = fitting.get(pair)
                if good is None:
                    good = fitting[pair] = fits(*pair)
                if good:
                    break
            last.append(token)
            if old is not None:
                same = same + 1 if token == old[end - start - 1] else 0
                if same == longest:
                    last += old[end - start:]
                    return end - start
        return len(data) - start

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` for the bytes from start to stop; returns how many last tokens were worked out."""
        tail, old = self.data[stop:], self.last[stop + 1:]
        self.cut(start)
        self.append(new)
        self.data += tail
        return len(new) + self._walk(start + len(new), old)

    def tokens(self) -> list[bytes]:
        """The encoding: last tokens from the end to the start."""
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end])
            end -= len(found[-1])
        return found[::-1]


class Encoder:
    """Texts to packed ids (unsigned 32-bit, little-endian), remembering pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.memory: dict[str, bytes] = {}
        self.remembered = 0
        self.known = Known()

    def _learn(self, new: list[str]) -> None:
        ranks = self.vocabulary.ranks
        walk = Prefixes(self.vocabulary, self.known)
        for data, piece in sorted((p.encode(), p) for p in new):
            if data in ranks:
                tokens = [data]
            else:
                shared, end = 0, min(len(data), len(walk.data))
                while shared < end and data[shared] == walk.data[shared]:
                    shared += 1
                walk.cut(shared)
                walk.append(data[shared:])
                tokens = walk.tokens()
            self.memory[piece] = np.fromiter((ranks[t] for t in tokens), "<u4", len(tokens)).tobytes()
            self.remembered += 100 + len(data)
        if len(self.known.fitting) + len(self.known.ending) > REMEMBERED_PAIRS:
            self.known = Known()

    def _joined(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.memory.__getitem__, pieces))

    def _know(self, pieces: set[str]) -> None:
        if self.remembered > REMEMBERED_BYTES:
            self.memory.clear()
            self.remembered = 0
        if new := [p for p in pieces if p not in self.memory]:
            self._learn(new)

    def packed(self, text: str) -> bytes:
        return next(self.all_packed([text]))

    def all_packed(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Texts are taken together up to ``PIECES`` pieces, a longer text in stretches of so many."""
        waiting, size = [], 0
        for text in texts:
            if len(text) > PIECES:
                yield from self._finished(waiting)
                waiting, size = [], 0
                found, out = self.pattern.finditer(text), []
                while stretch := [m.group() for m in islice(found, PIECES)]:
                    out += self._finished([stretch])
                yield b"".join(out)
                continue
            waiting.append(self.pattern.findall(text))
            size += len(waiting[-1])
            if size >= PIECES:
                yield from self._finished(waiting)
                waiting, size = [], 0
        yield from self._finished(waiting)

    def _finished(self, waiting: list[list[str]]) -> list[bytes]:
        self._know(set().union(*waiting))
        return [self._joined(pieces) for pieces in waiting]

    def decoded(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.pieces.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def updated(self, before: str, packed: bytes, after: str) -> tuple[bytes, int]:
        """(ids of ``after``, characters encoded), from the ids of ``before``.

        Where a character that is not white space stands before one that is, the pattern has a
        boundary whatever else is in the text. Ids before the last such place ahead of the change
        and behind the first one after it stay.
        """
        same = 0
        end = min(len(before), len(after))
        while same < end and before[same] == after[same]:
            same += 1
        tail = 0
        while tail < end - same and before[-tail - 1] == after[-tail - 1]:
            tail += 1
        start = _boundary_before(after, same)
        stop = _boundary_after(after, len(after) - tail)
        kept = len(after) - stop
        head = self._ids_over(packed, len(before[:start].encode()), forward=True)
        rest = self._ids_over(packed, len(before[len(before) - kept:].encode()), forward=False) if kept else b""
        return head + self.packed(after[start:stop]) + rest, stop - start

    def _ids_over(self, packed: bytes, size: int, forward: bool) -> bytes:
        """The first (or last) ids that stand for ``size`` bytes."""
        ids = np.frombuffer(packed, "<u4")
        lengths = np.fromiter((len(self.vocabulary.pieces[i]) for i in ids.tolist()), np.int64, len(ids))
        sums = np.cumsum(lengths if forward else lengths[::-1])
        count = int(np.searchsorted(sums, size, "left")) + 1 if size else 0
        if size and (count > len(sums) or sums[count - 1] != size):
            raise ValueError("the ids do not belong to the text")
        return ids[:count].tobytes() if forward else ids[len(ids) - count:].tobytes()


def _encoder(vocabulary: Vocabulary, pattern: str) -> Encoder:
    """The encoder lives with the vocabulary, which a worker keeps from task to task."""
    if pattern not in vocabulary.encoders:
        vocabulary.encoders[pattern] = Encoder(vocabulary, pattern)
    return vocabulary.encoders[pattern]


def _boundary_before(text: str, place: int) -> int:
    """The last place, two characters or more ahead of ``place``, where white space follows another character."""
    for at in range(min(place, len(text) - 1) - 2, 0, -1):
        if text[at].isspace() and not text[at - 1].isspace():
            return at
    return 0


def _boundary_after(text: str, place: int) -> int:
    for at in range(place + 1, len(text)):
        if text[at].isspace() and not text[at - 1].isspace():
            return at
    return len(text)


def _as_text(value: pa.Scalar) -> str:
    found = value.as_py()
    return "" if found is None else found.decode("utf-8", "replace") if isinstance(found, bytes) else found


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def _ids(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<u4").view(np.int32)))


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield np.asarray(value.as_py() or [], "<u4").tobytes()


def _bytes(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


_MAKE = {"ids": _ids, "packed": _bytes, "decoded": _bytes, "n_encoded": lambda values: pa.array(values, pa.int32())}
_KIND = {"ids": "array<int>", "packed": "binary", "decoded": "binary"}


def _by_row(frame: DataFrame, drop: Sequence[str], added: dict[str, str], work) -> DataFrame:
    """``frame`` without ``drop``, with ``added`` (name: type); ``work(batch)`` yields the added values row by row."""
    kept = [f for f in frame.schema if f.name not in drop and f.name not in added]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {kind}" for n, kind in added.items()]
    names, make = [f.name for f in kept], [_MAKE[n] for n in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = work()
        for batch in batches:
            gathered, size, start = [], 0, 0

            def flush(stop: int) -> pa.RecordBatch:
                part = batch.slice(start, stop - start)
                columns = [build([row[i] for row in gathered]) for i, build in enumerate(make)]
                return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(n)) for n in names] + columns, [*names, *added])

            for i, row in enumerate(rows(batch)):
                gathered.append(row)
                size += sum(len(v) for v in row if isinstance(v, bytes))
                if size >= BATCH_BYTES:
                    yield flush(i + 1)
                    gathered, size, start = [], 0, i + 1
            if gathered:
                yield flush(batch.num_rows)

    return frame.mapInArrow(run, ", ".join(fields))


def encoded(
    docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", outputs: Sequence[str] = ("ids",)
) -> DataFrame:
    """``docs`` without its text, with the asked ``outputs``: ``ids`` (array of int), ``packed`` (the
    ids as little-endian unsigned 32-bit numbers) and ``decoded`` (bytes of the ids decoded again).

    Each match of ``pattern`` is encoded by itself; there are no special tokens. A null text counts as
    empty and has no ids. Bytes that are not UTF-8 are replaced by U+FFFD first. Columns of
    ``docs`` named as an output are replaced, all others stay, null ids and repeated rows too.
    """
    if unknown := set(outputs) - set(_KIND):
        raise ValueError(f"no such output: {sorted(unknown)}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    spread = tuple(outputs)

    def work():
        encoder = _encoder(shared.value, pattern)

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            texts = map(_as_text, _binary(batch.column(batch.schema.get_field_index(text))))
            for packed in encoder.all_packed(texts):
                yield tuple(encoder.decoded(packed) if name == "decoded" else packed for name in spread)

        return rows

    return _by_row(docs, [text], {name: _KIND[name] for name in spread}, work)


def decoded(frame: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``frame`` with ``decoded``, the bytes of its column of ids; null or no ids are no bytes. An id
    outside the vocabulary is an error."""
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary)

    def work():
        encoder = _encoder(shared.value, "")

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for packed in _unpacked(batch.column(batch.schema.get_field_index(ids))):
                yield (encoder.decoded(packed),)

        return rows

    return _by_row(frame, [], {"decoded": "binary"}, work)


def re_encoded(
    frame: DataFrame, vocabulary: Vocabulary, pattern: str, before: str = "before", ids: str = "ids", after: str = "after"
) -> DataFrame:
    """Ids of changed texts from the ids of the texts ``before``: appends and edits encode only what is near them.

    ``frame`` loses ``before``; ``ids`` are those of ``after``, and ``n_encoded`` counts the characters that
    were encoded. Null texts count as empty, null ids as none. ``pattern`` must have a boundary wherever
    white space follows another character, as the public patterns have.
    """
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary)

    def work():
        encoder = _encoder(shared.value, pattern)

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            old, new, known = (batch.column(batch.schema.get_field_index(c)) for c in (before, after, ids))
            for was, now, packed in zip(_binary(old), _binary(new), _unpacked(known), strict=True):
                yield encoder.updated(_as_text(was), packed, _as_text(now))

        return rows

    out = frame.withColumnRenamed(ids, "ids") if ids != "ids" else frame
    ids = "ids"
    return _by_row(out, [before], {"ids": _KIND["ids"], "n_encoded": "int"}, work)
