"""Token counts that follow edits: a segment tree over stretches of each text.

A text is cut where a blank stands between two characters that are no white space; no match of the
tokenizer's pattern reaches across such a place, so tokens of the parts add up. Leaves hold about
`LEAF_CHARS` characters between two cuts; inner nodes hold sums of characters and tokens.

An edit replaces `length` characters from `start` on by `text`, in the text as the edits before it left
it. The tree finds the leaves it touches; a neighbour is taken in where the cut towards it does not hold
any more. Only these are encoded again, and the sums above them corrected.

Leaves (characters and tokens of each, in order) can be kept in a table with the text and handed in
later, so that nothing but the touched leaves is ever encoded again.

Defined cases: a null text counts as the empty one; null or no edits change nothing; places beyond the
end mean the end, negative ones the beginning; a null replacement is empty. Every input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.bpe import BETWEEN_WORDS, Encoder, encoder_of, share_ranks

LEAF_CHARS = 128
LARGEST_LEAF = 4096

LEAF = pa.struct([("chars", pa.int32()), ("tokens", pa.int32())])
RESULT = (
    "n_tokens bigint, n_tokens_after bigint, encoded_chars bigint, text string,"
    " leaves array<struct<chars:int,tokens:int>>"
)


def leaves_of(text: str, encoder: Encoder) -> tuple[list[int], list[int]]:
    """Characters and tokens of the leaves of a text."""
    if not text:
        return [], []
    first, *later = BETWEEN_WORDS.split(text)
    tokens = np.empty(len(later) + 1, np.int64)
    tokens[0] = len(encoder.first[first])
    tokens[1:] = np.fromiter(map(len, map(encoder.later.__getitem__, later)), np.int64, len(later))
    chars = np.empty(len(later) + 1, np.int64)
    chars[0] = len(first)
    chars[1:] = np.fromiter(map(len, later), np.int64, len(later))
    chars[1:] += 1
    before = np.cumsum(chars) - chars
    starts = np.flatnonzero(np.diff(before // LEAF_CHARS, prepend=-1))
    return np.add.reduceat(chars, starts).tolist(), (np.add.reduceat(tokens, starts) // 4).tolist()


class SegmentTree:
    """Sums over leaves; children of node i are 2 i and 2 i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1 << max(len(chars) - 1, 0).bit_length()
        self.chars = [0] * self.size + chars + [0] * (self.size - len(chars))
        self.tokens = [0] * self.size + tokens + [0] * (self.size - len(tokens))
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at `place`, and the place within it."""
        i = 1
        while i < self.size:
            i *= 2
            if place >= self.chars[i]:
                place -= self.chars[i]
                i += 1
        return i - self.size, place

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.size
        more_chars, more_tokens = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more_chars
            self.tokens[i] += more_tokens
            i //= 2


class CountedText:
    def __init__(self, text: str, encoder: Encoder, leaves: tuple[list[int], list[int]] | None = None):
        self.encoder, self.encoded = encoder, 0
        if leaves is None:
            leaves = leaves_of(text, encoder)
            self.encoded = len(text)
        ends = np.cumsum(leaves[0]).tolist()
        self.texts = [text[b - n : b] for b, n in zip(ends, leaves[0])]
        self._grow(leaves)

    def _grow(self, leaves: tuple[list[int], list[int]]) -> None:
        self.tree = SegmentTree(*leaves)
        self.texts += [""] * (self.tree.size - len(self.texts))

    @property
    def tokens(self) -> int:
        return self.tree.tokens[1]

    def leaves(self) -> list[dict[str, int]]:
        size = self.tree.size
        pairs = zip(self.tree.chars[size:], self.tree.tokens[size:])
        return [{"chars": c, "tokens": t} for c, t in pairs if c]

    def _beside(self, i: int, step: int) -> int | None:
        """The next leaf with text in a direction."""
        i += step
        while 0 <= i < len(self.texts) and not self.texts[i]:
            i += step
        return i if 0 <= i < len(self.texts) else None

    def edit(self, start: int, length: int, replacement: str) -> None:
        total = self.tree.chars[1]
        start = min(max(start, 0), total)
        stop = min(max(start + max(length, 0), start), total)
        i, within = self.tree.find(min(start, max(total - 1, 0)))
        within += start - min(start, max(total - 1, 0))
        j, end = self.tree.find(max(stop - 1, start) if stop < total else max(total - 1, 0))
        end += stop - (max(stop - 1, start) if stop < total else max(total - 1, 0))
        first, last = i, max(i, j)
        if last == first:
            text = self.texts[i][:within] + replacement + self.texts[i][within + stop - start :]
        else:
            text = self.texts[i][:within] + replacement + self.texts[last][end:]
        while (k := self._beside(first, -1)) is not None and not BETWEEN_WORDS.match(
            self.texts[k][-1:] + text[:2], 1
        ):
            first, text = k, self.texts[k] + text
        while (k := self._beside(last, 1)) is not None and not BETWEEN_WORDS.match(
            text[-1:] + self.texts[k][:2], 1
        ):
            last, text = k, text + self.texts[k]
        self.encoded += len(text)
        for k in range(first, last + 1):
            if self.texts[k]:
                self.texts[k] = ""
                self.tree.put(k, 0, 0)
        if len(text) <= LARGEST_LEAF:
            self.texts[first] = text
            self.tree.put(first, len(text), len(self.encoder.encode(text)) // 4)
            return
        # The leaf would be too large: it is cut, and the tree built anew from the leaves' counts.
        chars, tokens = leaves_of(text, self.encoder)
        ends = np.cumsum(chars).tolist()
        size = self.tree.size
        own = list(zip(self.texts, self.tree.chars[size:], self.tree.tokens[size:]))
        own[first : first + 1] = [(text[b - n : b], n, t) for b, n, t in zip(ends, chars, tokens)]
        own = [x for x in own if x[0]]
        self.texts = [x[0] for x in own]
        self._grow(([x[1] for x in own], [x[2] for x in own]))


def edited(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    column: str = "recount",
    text_col: str = "text",
    edits_col: str = "edits",
    leaves_col: str | None = None,
) -> DataFrame:
    """All columns of `docs` but the edits, and a struct `column`: n_tokens before the edits and
    n_tokens_after, the characters that were encoded for it, the edited text and its leaves.
    `edits_col` is an array of (start, length, text) in the order of their application."""
    drop = [column, edits_col, *([leaves_col] if leaves_col else [])]
    kept = docs.drop(*drop)
    shared, name = share_ranks(docs.sparkSession, ranks_path, pattern)
    kind = pa.struct(
        [
            ("n_tokens", pa.int64()),
            ("n_tokens_after", pa.int64()),
            ("encoded_chars", pa.int64()),
            ("text", pa.string()),
            ("leaves", pa.list_(LEAF)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared, pattern, name)
        for batch in batches:
            column_of = lambda x: batch.column(batch.schema.get_field_index(x)).to_pylist()
            rows = []
            for text, edits, known in zip(column_of("_text"), column_of("_edits"), column_of("_leaves")):
                leaves = None
                if known is not None:
                    leaves = [x["chars"] for x in known], [x["tokens"] for x in known]
                counted = CountedText(text or "", encoder, leaves)
                before = counted.tokens
                for edit in edits or []:
                    counted.edit(edit["start"], edit["length"], edit["text"] or "")
                rows.append(
                    {
                        "n_tokens": before,
                        "n_tokens_after": counted.tokens,
                        "encoded_chars": counted.encoded,
                        "text": "".join(counted.texts),
                        "leaves": counted.leaves(),
                    }
                )
            out = batch.drop_columns(["_text", "_edits", "_leaves"])
            yield out.append_column(column, pa.array(rows, kind))

    none = F.lit(None).cast("array<struct<chars:int,tokens:int>>")
    given = docs.select(
        *(F.col(c) for c in kept.columns),
        F.col(text_col).cast("string").alias("_text"),
        F.col(edits_col).alias("_edits"),
        (F.col(leaves_col) if leaves_col else none).alias("_leaves"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    struct = RESULT.replace(" bigint", ":bigint").replace(" string", ":string").replace(" array", ":array")
    return given.mapInArrow(run, f"{schema}, `{column}` struct<{struct}>")


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", order_col: str = "seq") -> DataFrame:
    """`docs` with the edits of each id from a table of (id, order, start, length, text), in their
    order. Edits of one text depend on each other, so they are gathered for each text."""
    steps = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("seq"), "start", "length", "text")))
    gathered = edits.groupBy(F.col(id_col).alias("_edited")).agg(
        F.transform(steps, lambda x: F.struct(x["start"], x["length"], x["text"])).alias("edits")
    )
    return docs.join(gathered, docs[id_col] == gathered["_edited"], "left").drop("_edited")
