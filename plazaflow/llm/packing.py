"""Hierarchical multi-length packing of documents into training sequences.

Every text is encoded and closed by an end token. A document longer than the largest context is cut
into full windows first. What is left of it, or a shorter document, is routed to the smallest tier
(context size) that holds it. Tiers are packed from the longest to the shortest: a window takes its
piece, then the longest pieces of shorter tiers that fit its gap, and the last gap is closed by a piece
that is cut, whose rest is routed again. So windows are full, and each is as short as its first piece
lets it be. All windows have a power of two of tokens: nothing is padded.

The windows of a pool are dealt to step groups of about `STEP_TOKENS`, longest and costliest first and
each to the group with the fewest tokens so far (then the least attention cost, the sum of squared
piece lengths), so steps have like numbers of tokens and like costs.

Tasks pack what they read: nothing is shuffled, and a task holds one pool (`POOL_TOKENS` and the
document that exceeds it). A window that a pool cannot fill waits for the next pool; at the end of
the task the rest, less than one window of each pool's last, is cut into windows of falling powers of
two. Sequence and step numbers are unique by the number of the task's partition.

The encoder keeps the ids of words between blanks, which no token crosses, in a table of about
`MAX_WORDS` entries for each Python worker, the older half of which is dropped when it is full.

Defined cases: a null or empty text is its end token alone. Null ids stay null; repeated rows are
packed each; an empty table gives an empty one. Other columns are left out.
"""

from __future__ import annotations

import array
import bisect
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 2048
TIERS = (2048, 1024, 512, 256)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 16 * SIZE
MARKS = frozenset(".,;:!?")
# Words whose ids a task keeps, and characters of texts encoded at once.
MAX_WORDS = 800_000
CHARS_AT_ONCE = 1 << 20

# A byte as the letter that stands for it in a vocabulary of bytes: printable ones stand for themselves.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = dict(zip(sorted(set(range(256)) - set(_PRINTABLE)), range(256, 512)))

COLUMNS = (
    "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "context int, step_id bigint"
)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this Python worker, which serves one task after the other."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Ids of texts as bytes (little-endian, 32 bits each).

    For tokenizers of bytes that take text in NFC and lower case and whose tokens end at blanks and
    between letters and marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _add(self, words: list[str]) -> None:
        """Words of Latin small letters go to the merges at once: nothing is normalised or split in them."""
        tokenize, known, others = self.model.tokenize, self.known, []
        for word in words:
            if word.isascii():
                plain = word
            elif max(word) < "\u0180":
                plain = word.encode().decode("latin-1").translate(BYTE_LETTERS)
            else:
                others.append(word)
                continue
            known[word] = array.array("I", [t.id for t in tokenize(plain)]).tobytes()
        self._add_any(others)

    def _add_any(self, words: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self.known.update((w, array.array("I", e.ids).tobytes()) for w, e in zip(words, found))

    def _learn(self, words: set[str]) -> None:
        """Adds words; a single mark after a letter is a token of its own, ASCII capitals do not count."""
        known = self.known
        small = [w for w in words if w.isalpha() and w.islower()]
        self._add(small)
        cut, stems = [], set()
        for word in words.difference(small):
            end = word[-1:] if word[-1:] in MARKS and word[-2:-1].isalpha() else ""
            stem = word[:-1] if end else word
            stem = stem.lower() if stem.isascii() else stem
            cut.append((word, stem, end))
            stems.add(stem)
            stems.add(end)
        stems = {s for s in stems if s not in known}
        small = [w for w in stems if w.isalpha() and w.islower()]
        self._add(small)
        self._add_any(list(stems.difference(small)))
        for word, stem, end in cut:
            known[word] = known[stem] + known[end]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            if len(self.known) > MAX_WORDS:
                for word in list(self.known)[: len(self.known) // 2]:
                    del self.known[word]
                new = set().union(*split).difference(self.known)
            self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


class Packer:
    """Packs pieces (length, document, start) into windows; `windows` of a pool are (size, pieces)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = sorted(tiers)
        self.size = self.tiers[-1]
        self.free: list[tuple[int, int, int]] = []  # in ascending order

    def add(self, document: int, length: int) -> list[tuple[int, list]]:
        """Takes a document in; the full windows that it fills by itself."""
        full, rest = divmod(length, self.size)
        if rest:
            bisect.insort(self.free, (rest, document, full * self.size))
        return [(self.size, [(self.size, document, i * self.size)]) for i in range(full)]

    def _filler(self, gap: int) -> tuple[int, int, int] | None:
        """The longest piece within the gap, else the gap's share of the next longer one."""
        if not self.free:
            return None
        at = bisect.bisect_left(self.free, (gap + 1,))
        if at:
            return self.free.pop(at - 1)
        length, document, start = self.free.pop(0)
        bisect.insort(self.free, (length - gap, document, start + gap))
        return gap, document, start

    def pack(self) -> Iterator[tuple[int, list]]:
        """Full windows; the pieces of one that cannot be filled are kept."""
        while self.free:
            pieces = [self.free.pop()]
            context = self.tiers[bisect.bisect_left(self.tiers, pieces[0][0])]
            gap = context - pieces[0][0]
            while gap:
                piece = self._filler(gap)
                if piece is None:
                    self.free = sorted(pieces)
                    return
                pieces.append(piece)
                gap -= piece[0]
            yield context, pieces

    def rest(self) -> Iterator[tuple[int, list]]:
        """What is left, in windows of falling powers of two."""
        left = sum(p[0] for p in self.free)
        while left:
            context = min(self.size, 1 << (left.bit_length() - 1))
            pieces, gap = [], context
            while gap:
                piece = self._filler(gap)
                pieces.append(piece)
                gap -= piece[0]
            left -= context
            yield context, pieces


def steps_of(windows: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """For each window its group: like numbers of tokens, then like sums of squared lengths."""
    total = sum(size for size, _ in windows)
    groups = [(0, 0, g) for g in range(max(1, round(total / step_tokens)))]
    cost = [sum(p[0] ** 2 for p in pieces) for _, pieces in windows]
    found = [0] * len(windows)
    for w in sorted(range(len(windows)), key=lambda w: (-windows[w][0], -cost[w])):
        tokens, spent, g = groups[0]
        heapq.heapreplace(groups, (tokens + windows[w][0], spent + cost[w], g))
        found[w] = g
    return found


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about CHARS_AT_ONCE characters at a time."""
    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= CHARS_AT_ONCE:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece: its document's id, `COLUMNS`; ids are little-endian numbers of 32 bits.

    `tiers` are powers of two. `offset` is the piece's place in its sequence, `context` the
    sequence's size, `step_id` its step group.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError(f"context sizes are powers of two, not {tiers}")
    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(f"{id_col}_text"))
    kind = picked.schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        encoder, packer = encoder_of(tokenizer), Packer(tiers)
        open_docs: dict[int, tuple] = {}  # number -> id, ids; those with pieces not yet given out
        number = sequences = steps = held = 0
        full: list[tuple[int, list]] = []
        id_type = None

        def given_out(windows: list[tuple[int, list]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequences, steps
            of_window = steps_of(windows, step_tokens)
            out: list[list] = [[] for _ in range(9)]
            size = 0
            for (context, pieces), step in zip(windows, of_window):
                offset = 0
                for length, document, start in pieces:
                    key, ids = open_docs[document]
                    row = (
                        key, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4,
                        base + sequences, offset, context, base + steps + step,
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                    offset += length
                size += context
                sequences += 1
                if size >= POOL_TOKENS:
                    yield rows_of(out)
                    out, size = [[] for _ in range(9)], 0
            steps += max(of_window, default=-1) + 1
            if out[0]:
                yield rows_of(out)

        def rows_of(out: list[list]) -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = [id_col, *(c.split()[0] for c in COLUMNS.split(", "))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

        def typed(batches):
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for keys, texts in _in_slices(typed(batches)):
            for key, ids in zip(keys, encoder.encode(texts)):
                ids += end
                open_docs[number] = (key, ids)
                full += packer.add(number, len(ids) // 4)
                held += len(ids) // 4
                number += 1
                if held >= pool_tokens:
                    yield from given_out(full + list(packer.pack()))
                    open_docs = {d: open_docs[d] for _, d, _ in packer.free}
                    full, held = [], sum(p[0] for p in packer.free)
        last = full + list(packer.pack())
        yield from given_out(last + list(packer.rest()))

    return picked.mapInArrow(run, f"`{id_col}` {kind}, {COLUMNS}")
