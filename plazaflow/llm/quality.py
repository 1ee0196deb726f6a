"""Quality rules with thresholds that adapt to language and source, by DataFrame functions only.

Every text is measured. Measures that say something about the kind of text are turned into whole
numbers and counted in a sketch for each language and source: logarithmic buckets of whole numbers, exact
below 2^SKETCH_BITS and with that many leading bits above. Sketches are tables of (group, measure,
bucket, count), so merging is adding counts, in any order and with the same result; each task adds up its
part before the shuffle, and a group of a third of all rows is a few hundred buckets like any other.

Thresholds are quantiles read from the sketches: the median plus or minus `SPREADS` times the
distance between the median and a quantile on the side of the ordinary texts, with a least
distance. A group of fewer than `MIN_ROWS` texts takes those of its language, and a language of
fewer those of all texts. Texts join the thresholds of their group and are kept within them.

Base rules hold for every text: at least 10 words, and at most a fifth of the words in windows of 5
words that occur twice or more in it.

Defined cases: a null text has no words and fails the base rules; an empty table gives an empty one.
Null languages and sources are groups like others. Repeated rows are measured and counted each.
Windows are compared by a 64-bit hash of their words' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaflow.llm.tables import settled

BLANKS = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SKETCH_BITS = 6
MIN_ROWS = 100
SPREADS = 8
# Measure, the quantile on the side of the ordinary texts, side of the threshold, least distance.
RULES = (
    ("symbols_per_mille", 0.25, 1, 10),
    ("dup_lines_per_mille", 0.25, 1, 25),
    ("repeated_per_mille", 0.25, 1, 25),
    ("word_centi_chars", 0.25, 1, 40),
    ("word_centi_chars", 0.75, -1, 40),
)
MEASURES = tuple(dict.fromkeys(r[0] for r in RULES))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bound(value: Column, use) -> Column:
    """`use` applied to a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the hashes of a text's words."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
        lambda i: F.xxhash64(*(F.element_at(hashes, i + j) for j in range(WINDOW))),
    )

    def places(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _bound(
            pairs,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, i: F.when(
                        (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda x: x.isNotNull(),
            ),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(windows: Column) -> Column:
        several = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(several, _bound(F.sort_array(places(windows)), covered)).otherwise(F.lit(0))

    return F.when(F.size(hashes) >= WINDOW, _bound(windows, count)).otherwise(F.lit(0))


def measured(docs: DataFrame, *keys: str, text_col: str = "text") -> DataFrame:
    """The columns `keys` of `docs` and the counts of each text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, f"{BLANKS}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = _bound(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            _bound(F.transform(w, lambda x: F.xxhash64(x)), _repeated_words).alias("n_repeat_words"),
        ),
    )
    of_lines = _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    found = docs.select(
        *keys,
        of_words.alias("w"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("s"),
        F.struct(F.size(lines).alias("n"), of_lines.alias("dup")).alias("l"),
    )
    return found.select(
        *keys,
        F.col("w.n_words").cast("bigint").alias("n_words"),
        F.col("w.word_chars").cast("bigint").alias("word_chars"),
        F.col("s").cast("bigint").alias("n_symbols"),
        F.col("l.dup").cast("bigint").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("bigint").alias("n_repeat_words"),
        F.col("l.n").cast("bigint").alias("_n_lines"),
    )


def _share(part: str, whole: str, times: int) -> Column:
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * times / F.col(whole))).otherwise(F.lit(0))


def _values() -> dict[str, Column]:
    return {
        "symbols_per_mille": _share("n_symbols", "word_chars", 1000),
        "dup_lines_per_mille": _share("n_dup_lines", "_n_lines", 1000),
        "repeated_per_mille": _share("n_repeat_words", "n_words", 1000),
        "word_centi_chars": _share("word_chars", "n_words", 100),
    }


def bucket(value: Column) -> Column:
    """The smallest number of the sketch's bucket that holds a whole number."""
    step = F.lit(1).cast("bigint")
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift) * step


def sketches(counts: DataFrame, *groups: str) -> DataFrame:
    """Sketches of all measures by group: (groups, measure, bucket, n)."""
    pairs = F.explode(
        F.array(*(F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in _values().items()))
    )
    cells = counts.where(F.col("n_words") > 0).select(*groups, pairs.alias("p"))
    return cells.groupBy(*groups, F.col("p.measure").alias("measure"), F.col("p.bucket").alias("bucket")).agg(
        F.count("*").alias("n")
    )


def merged(sketch: DataFrame, *groups: str) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def thresholds(sketch: DataFrame, *groups: str) -> DataFrame:
    """For each group, its number of texts and an array of thresholds in the order of RULES."""
    cells = F.array_sort(F.collect_list(F.struct("bucket", "n")))  # a sketch has few buckets
    rows = sketch.groupBy(*groups, "measure").agg(cells.alias("cells"), F.sum("n").alias("rows"))

    def quantile(cells: Column, rows: Column, q: float) -> Column:
        rank = F.ceil(rows * q)
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("value"))

        def step(state: Column, cell: Column) -> Column:
            value = F.when(state["seen"] < rank, cell["bucket"]).otherwise(state["value"])
            return F.struct((state["seen"] + cell["n"]).alias("seen"), value.alias("value"))

        return F.aggregate(cells, start, step, lambda s: s["value"])

    quantiles = {q for _, q, _, _ in RULES} | {0.5}
    known = rows.select(
        *groups,
        "measure",
        "rows",
        *(quantile(F.col("cells"), F.col("rows"), q).alias(f"q{int(q * 100)}") for q in sorted(quantiles)),
    )
    limits = []
    for i, (measure, q, side, least) in enumerate(RULES):
        distance = F.greatest(F.abs(F.col("q50") - F.col(f"q{int(q * 100)}")), F.lit(least))
        limit = F.when(F.col("measure") == measure, F.col("q50") + side * SPREADS * distance)
        limits.append(F.max(limit).alias(f"limit_{i}"))
    return (
        known.groupBy(*groups)
        .agg(F.max("rows").alias("rows"), *limits)
        .select(*groups, "rows", F.array(*(f"limit_{i}" for i in range(len(RULES)))).alias("limits"))
    )


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of `docs`: its id, the counts, base_failed and kept."""
    picked = docs.select(
        F.col(id_col).alias("_id"),
        F.col(lang_col).alias("_lang"),
        F.col(source_col).alias("_source"),
        F.col(text_col).alias("_text"),
    )
    counts = settled(measured(picked, "_id", "_lang", "_source", text_col="_text"))
    fine = sketches(counts, "_lang", "_source")
    wide = merged(fine, "_lang")
    by_source = thresholds(fine, "_lang", "_source").select(
        F.col("_lang").alias("l"), F.col("_source").alias("s"), F.col("rows").alias("own_rows"), F.col("limits").alias("own")
    )
    by_lang = thresholds(wide, "_lang").select(
        F.col("_lang").alias("l"), F.col("rows").alias("lang_rows"), F.col("limits").alias("lang_limits")
    )
    everywhere = thresholds(merged(wide)).select(F.col("limits").alias("all_limits"))
    enough = F.col("own_rows") >= MIN_ROWS
    limits = (
        by_source.join(by_lang.withColumnRenamed("l", "l2"), F.col("l").eqNullSafe(F.col("l2")))
        .join(everywhere, F.lit(True), "left")
        .select(
            "l",
            "s",
            F.when(enough, F.col("own"))
            .when(F.col("lang_rows") >= MIN_ROWS, F.col("lang_limits"))
            .otherwise(F.col("all_limits"))
            .alias("limits"),
        )
    )
    same = F.col("_lang").eqNullSafe(F.col("l")) & F.col("_source").eqNullSafe(F.col("s"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    within, values = F.lit(True), _values()
    for i, (measure, _, side, _) in enumerate(RULES):
        limit = F.col("limits")[i]
        within &= values[measure] <= limit if side > 0 else values[measure] >= limit
    return counts.join(limits, same, "left").select(
        F.col("_id").alias(id_col),
        *COUNTS,
        base_failed.alias("base_failed"),
        (~base_failed & F.coalesce(within, F.lit(True))).alias("kept"),
    )
