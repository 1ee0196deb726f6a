"""Benchmark decontamination: test windows in a broadcast hash set, scanned over training texts.

A test item is cut in windows of `size` consecutive words; an item of fewer words, but not none, is
one window. Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z in
lower case. A document word inside any occurrence of a window is hit. Windows are looked up by
hash and verified by their words, so no collision makes a hit.

The windows are broadcast only while there are at most `max_broadcast` of them (about 100 bytes
each). Beyond that, windows of documents and items meet in a shuffled join on the same hashes.

Defined cases: a null or empty text has no words and no hit; so has a document if there are no
items. Items whose id is null make hits but are not named. Repeated rows each get their result, and
repeated items count once. Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.spans import ALNUM, Run, runs, signed
from plazaflow.llm.tables import with_text

WINDOW = 10
MAX_BROADCAST = 250_000
FILTER_BITS = 20

HIT = (
    "n_words bigint, n_hit bigint, items array<bigint>,"
    " spans array<struct<start:bigint,stop:bigint>>"
)
_HIT_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]
)


def item_windows(benchmark: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """One row per item and window: its number of words, hash, and words joined by blanks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), []
            for run in runs(batch.column(1), ALNUM):
                for i in range(run.n):
                    a, b = run.bounds[i], run.bounds[i + 1]
                    if a == b:
                        continue
                    k = min(size, int(b - a))
                    hashes = signed(run.windows(k)[0])
                    rows += [
                        (ids[run.first + i].as_py(), k, int(hashes[j]), _joined(run, j, k))
                        for j in range(a, b - k + 1)
                    ]
            columns = list(zip(*rows)) or [[]] * 4
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["item", "k", "hash", "words"]
            )

    picked = benchmark.select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    return picked.mapInArrow(cut, "item bigint, k int, hash bigint, words binary")


def _joined(run: Run, i: int, k: int) -> bytes:
    return b" ".join(run.word(j) for j in range(i, i + k))


class _Index:
    """Windows by length and words, with a bit table on the hashes before the exact lookup."""

    def __init__(self, rows: list):
        self.items: dict[tuple[int, bytes], tuple[int, ...]] = {}
        hashes: dict[int, set[int]] = {}
        for row in rows:
            self.items[row.k, bytes(row.words)] = tuple(row["items"])
            hashes.setdefault(row.k, set()).add(row.hash)
        self.hashes = {k: np.sort(np.fromiter(v, np.int64, len(v))) for k, v in hashes.items()}
        self.bits = {}
        for k, values in self.hashes.items():
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[values.view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
            self.bits[k] = bits

    def found(self, run: Run) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """Place, length and items of every window that occurs."""
        for k, bits in self.bits.items():
            hashes, within = run.windows(k)
            near = np.flatnonzero(within & bits[hashes >> np.uint64(64 - FILTER_BITS)])
            if len(near):
                values = self.hashes[k]
                at = np.searchsorted(values, own := signed(hashes[near]))
                near = near[values[np.minimum(at, len(values) - 1)] == own]
            for i in near.tolist():
                items = self.items.get((k, _joined(run, i, k)))
                if items is not None:
                    yield i, k, items


def _char_spans(run: Run, i: int, first: np.ndarray, last: np.ndarray) -> list[dict[str, int]]:
    """Stretches of words, from first to last, as code point places in text i."""
    begin = run.cuts[i]
    starts = (run.data[begin : run.cuts[i + 1]] & 0xC0) != 0x80
    places = np.concatenate(([0], np.cumsum(starts)))
    return [
        {"start": int(places[run.start[a] - begin]), "stop": int(places[run.end[b] - begin])}
        for a, b in zip(first, last)
    ]


def _scan(index: _Index, texts: pa.Array) -> list[dict]:
    out = []
    for run in runs(texts, ALNUM):
        n = len(run.hash)
        edge, items = np.zeros(n + 1, dtype=np.int32), {}
        for i, k, ids in index.found(run):
            edge[i] += 1
            edge[i + k] -= 1
            doc = int(np.searchsorted(run.bounds, i, side="right")) - 1
            items.setdefault(doc, set()).update(ids)
        hit = np.cumsum(edge[:n]) > 0
        sums = np.concatenate(([0], np.cumsum(hit)))[run.bounds]
        for i in range(run.n):
            a, b = int(run.bounds[i]), int(run.bounds[i + 1])
            row = {"n_words": b - a, "n_hit": int(sums[i + 1] - sums[i]), "items": [], "spans": []}
            if row["n_hit"]:
                own = hit[a:b].astype(np.int8)
                turns = np.diff(np.concatenate(([0], own, [0])))
                first, last = a + np.flatnonzero(turns == 1), a + np.flatnonzero(turns == -1) - 1
                row["items"] = sorted(items[i])
                row["spans"] = _char_spans(run, i, first, last)
            out.append(row)
    return out


def _windows_by_words(benchmark: DataFrame, key: str, text: str, size: int) -> DataFrame:
    return (
        item_windows(benchmark, key, text, size)
        .groupBy("k", "hash", "words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def marked(
    docs: DataFrame,
    benchmark: DataFrame,
    column: str = "hit",
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """All columns of `docs` and a struct `column`: n_words, n_hit, items (ids of the items with
    occurring windows, ascending) and spans (hit stretches, as code point places). A column of
    that name in `docs` is replaced."""
    docs = docs.drop(column)
    windows = _windows_by_words(benchmark, item_col, item_text_col, size)
    rows = windows.limit(max_broadcast + 1).collect()
    if len(rows) > max_broadcast:
        return _marked_by_join(docs, windows, column, text_col, size)
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(_Index(rows))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array(_scan(index, texts), _HIT_ARROW)
            yield batch.select(kept).append_column(column, found)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return given.mapInArrow(scan, f"{schema}, `{column}` struct<{HIT}>")


def _marked_by_join(
    docs: DataFrame, windows: DataFrame, column: str, text_col: str, size: int
) -> DataFrame:
    """The same, for items too many to broadcast. Texts are told apart by their own words."""
    lengths = [r.k for r in windows.select("k").distinct().collect()]  # at most `size` of them

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch.column(1), ALNUM):
                doc = np.repeat(np.arange(run.n), np.diff(run.bounds))
                keys = batch.column(0).to_numpy(zero_copy_only=False)[run.first + doc]
                for k in lengths:
                    hashes, within = run.windows(k)
                    at = np.flatnonzero(within)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[at]),
                            pa.array(at - run.bounds[doc[at]]),
                            pa.array(np.full(len(at), k, np.int32)),
                            pa.array(signed(hashes[at])),
                            pa.array([_joined(run, i, k) for i in at.tolist()], pa.binary()),
                        ],
                        ["_key", "place", "k", "hash", "words"],
                    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hit words as spans, once a text and its hit windows have met."""
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text"))
            found = batch.column(batch.schema.get_field_index("_found"))
            rows = []
            for run in runs(texts, ALNUM):
                for i in range(run.n):
                    a, b = int(run.bounds[i]), int(run.bounds[i + 1])
                    row = {"n_words": b - a, "n_hit": 0, "items": [], "spans": []}
                    hits = found[run.first + i].as_py()
                    if hits:
                        hit = np.zeros(b - a + 2, dtype=np.int8)
                        for x in hits["windows"]:
                            hit[x["place"] + 1 : x["place"] + 1 + x["k"]] = 1
                        turns = np.diff(hit)
                        row["n_hit"] = int(hit.sum())
                        row["items"] = hits["items"]
                        row["spans"] = _char_spans(
                            run, i, a + np.flatnonzero(turns == 1), a + np.flatnonzero(turns == -1) - 1
                        )
                    rows.append(row)
            kept = batch.drop_columns(["_text", "_found", "_key"])
            yield kept.append_column(column, pa.array(rows, _HIT_ARROW))

    text = F.col(text_col).cast("string")
    keyed = docs.withColumn("_text", text).withColumn("_key", F.xxhash64(text))
    texts = keyed.select("_key", "_text").dropDuplicates(["_key"])
    met = (
        texts.mapInArrow(cut, "_key bigint, place bigint, k int, hash bigint, words binary")
        .join(windows, ["k", "hash", "words"])
        .groupBy("_key")
        .agg(
            F.struct(
                F.collect_set(F.struct("place", "k")).alias("windows"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            ).alias("_found")
        )
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return keyed.join(met, "_key", "left").mapInArrow(place, f"{schema}, `{column}` struct<{HIT}>")


def without_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of any item, with their own columns."""
    flag = "_contamination"
    return marked(docs, benchmark, flag, **options).where(f"{flag}.n_hit = 0").drop(flag)


def without_spans(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """All documents with their own columns, the hit stretches cut out of their texts."""
    flag = "_contamination"
    pieces = F.expr(
        f"""concat(
            array_join(transform({flag}.spans, (x, i) -> substring(`{text_col}`,
                int(if(i = 0, 0, {flag}.spans[i - 1].stop)) + 1,
                int(x.start - if(i = 0, 0, {flag}.spans[i - 1].stop)))), ''),
            substring(`{text_col}`, int({flag}.spans[size({flag}.spans) - 1].stop) + 1))"""
    )
    found = marked(docs, benchmark, flag, text_col=text_col, **options)
    cut = F.when(F.col(f"{flag}.n_hit") > 0, pieces).otherwise(F.col(text_col))
    return found.withColumn(text_col, cut).drop(flag)
