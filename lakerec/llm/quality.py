"""Quality rules: thresholds taken from mergeable quantile sketches of each language and source.

Every text is measured once. The measures of the texts that pass the base rules are summed into quantile sketches, one
per (language, source) and measure. A sketch is a histogram over log-linear bins of non-negative integers: values below
64 have a bin each, larger ones share a bin with values within 1/32 of them. It is merged by adding counts, in any
order and with the same result, so Spark builds it with a counting aggregation that is combined before the shuffle: a
hot group costs one row per bin and task. Quantiles are read off the cumulated counts, fences are set from them, and
the texts are joined with the fences of their group and filtered.

Fences. For each measure the upper fence is ``q3 + reach * max(q3 - q1, q3 / 8, spread)`` with q1 and q3 the quartiles,
and for the mean word length there is a lower fence as well. They follow the group: a group of long words or many
marks has wide fences. Texts inside the fences stay, whatever their rank, so a group without outliers loses nothing.
Groups of fewer than ``min_group`` texts use the sketches of their language, and a language of fewer that of all texts
(sketches merge, so both are sums).

Defined cases: a null or empty text has no words and fails the base rules. A null language or source is a group like
any other. Repeated rows are each counted and judged. Extra columns pass through ``filtered`` untouched; columns that
have the name of a measure are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerec.llm import text as T
from lakerec.session import stored

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: measure -> (what is counted, per what, scale, least spread of the upper fence)
MEASURES = {
    "word_length": ("word_chars", "n_words", 100, 40),
    "symbols": ("n_symbols", "word_chars", 10_000, 100),
    "marks": ("n_marks", "word_chars", 10_000, 300),
    "upper": ("n_upper", "word_chars", 10_000, 300),
    "dup_lines": ("n_dup_lines", "n_lines", 10_000, 1_200),
    "repeats": ("n_repeat_words", "n_words", 10_000, 1_000),
}
LOWER_FENCED = ("word_length",)

_SYMBOL, _UPPER, _MARK = (np.zeros(256, dtype=bool) for _ in range(3))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeat_words(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the words inside windows of ``WINDOW`` words that occur twice or more in the text."""
    rows = len(first) - 1
    windows = T.window_hashes(values, WINDOW)
    owner = np.repeat(np.arange(rows), np.diff(first))[: len(windows)]
    whole = np.arange(len(windows)) + WINDOW <= first[owner + 1]
    place = np.flatnonzero(whole)
    keys = T.mix(windows[place] + T.mix(owner[place].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    often = np.zeros(len(place), dtype=bool)
    often[1:] |= same
    often[:-1] |= same
    begins = place[order[often]]
    change = np.zeros(len(values) + 1, dtype=np.int64)
    change[begins] += 1  # no place occurs twice in begins
    np.subtract.at(change, begins + WINDOW, 1)
    return _per_text(np.cumsum(change[:-1]) > 0, first)


def _dup_lines(data: np.ndarray, bounds: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the lines that hold a word, and those of them equal to an earlier line of the text."""
    rows = len(bounds) - 1
    breaks = np.flatnonzero(data == 10)
    filled = bounds[:-1] < bounds[1:]
    begins = np.unique(np.concatenate([bounds[:-1][filled], breaks + 1]))
    begins = begins[begins < len(data)]
    closing = np.append(breaks, len(data))
    ends = np.minimum(closing[np.searchsorted(closing, begins)], bounds[np.searchsorted(bounds, begins, "right")])
    solid = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~T.IS_SPACE[data], out=solid[1:])
    worded = solid[ends] > solid[begins]
    begins, ends = begins[worded], ends[worded]
    owner = np.searchsorted(bounds, begins, "right") - 1
    keys = T.mix(T.span_hashes(sums, begins, ends) + T.mix(owner.astype(np.uint64)))
    _, earliest = np.unique(keys, return_index=True)
    lines = np.bincount(owner, minlength=rows)
    return lines, lines - np.bincount(owner[earliest], minlength=rows)


def measure_batch(column: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text of an Arrow column."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    for _, _, data, bounds in T.slices(column):
        begins, ends, first = T.words(data, bounds)
        sums = T.prefix_sums(data)
        values = T.span_hashes(sums, begins, ends)
        starts_char = (data & 0xC0) != 0x80
        lines, repeated = _dup_lines(data, bounds, sums)
        found = {
            "n_words": np.diff(first),
            "word_chars": _per_text(starts_char & ~T.IS_SPACE[data], bounds),
            "n_symbols": _per_text(_SYMBOL[data], bounds),
            "n_dup_lines": repeated,
            "n_repeat_words": _repeat_words(values, first),
            "n_lines": lines,
            "n_upper": _per_text(_UPPER[data], bounds),
            "n_marks": _per_text(_MARK[data], bounds),
        }
        for name in COUNTS:
            parts[name].append(found[name])
    return {name: np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for name, p in parts.items()}


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with ``COUNTS`` and ``base_failed``."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS and c != "base_failed"]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    source = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = measure_batch(batch.column(1))
            arrays = [batch.column(0), *(pa.array(counts[name]) for name in COUNTS)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", *COUNTS])

    rows = source.mapInArrow(run, ", ".join([f"row {kind}", *(f"{name} bigint" for name in COUNTS)]))
    rows = rows.select(*[F.col("row")[c].alias(c) for c in kept], *COUNTS)
    return rows.withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def measure_value(name: str) -> Column:
    """The measure as a whole number, rounded down; 0 where there is nothing to divide by."""
    count, per, scale, _ = MEASURES[name]
    return F.expr(f"case when {per} > 0 then ({scale} * {count}) div {per} else 0 end")


def bin_of(value: Column) -> Column:
    """The least value of the log-linear bin that ``value`` falls into, by whole-number arithmetic."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0)).cast("bigint")
    width = F.pow(F.lit(2), shift).cast("bigint")
    return value - F.pmod(value, width)


def sketches(rows: DataFrame) -> DataFrame:
    """``(level, lang, source, measure, bin, n)``: level 2 a language's source, 1 a language, 0 all texts."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(measure_value(m)).alias("bin")) for m in MEASURES])
    cells = rows.where("not base_failed").select("lang", "source", F.explode(values).alias("v"))
    fine = cells.groupBy("lang", "source", "v.measure", "v.bin").agg(F.count("*").alias("n"))
    levels = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    spread = fine.select(
        levels.alias("level"), "lang", "source", "measure", "bin", "n"
    ).select(
        "level",
        F.expr("if(level >= 1, lang, null)").alias("lang"),
        F.expr("if(level >= 2, source, null)").alias("source"),
        "measure", "bin", "n",
    )
    return spread.groupBy("level", "lang", "source", "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, reach: int = 3, min_group: int = 30) -> DataFrame:
    """``(level, lang, source, <measure>_low, <measure>_high)`` of each group that has ``min_group`` texts, or level 0.

    Works on sketches: a few hundred bins per group at most, whatever the number of texts.
    """
    running = (
        sketch.selectExpr(
            "*",
            "sum(n) over (partition by level, lang, source, measure order by bin) as upto",
            "sum(n) over (partition by level, lang, source, measure) as total",
        )
    )
    quartiles = running.groupBy("level", "lang", "source", "measure").agg(
        F.max("total").alias("total"),
        F.min(F.expr("case when 4 * upto >= total then bin end")).alias("q1"),
        F.min(F.expr("case when 4 * upto >= 3 * total then bin end")).alias("q3"),
    )
    least = F.coalesce(*[F.when(F.col("measure") == m, F.lit(spec[3])) for m, spec in MEASURES.items()])
    span = F.greatest(F.expr("q3 - q1"), F.expr("q3 div 8"), least).cast("bigint")
    ranges = quartiles.where(f"level = 0 or total >= {int(min_group)}").select(
        "level", "lang", "source", "measure",
        (F.col("q3") + reach * span).alias("high"), (F.col("q1") - reach * span).alias("low"),
    )
    high = [F.max(F.when(F.col("measure") == m, F.col("high"))).alias(f"{m}_high") for m in MEASURES]
    low = [F.max(F.when(F.col("measure") == m, F.col("low"))).alias(f"{m}_low") for m in LOWER_FENCED]
    return ranges.groupBy("level", "lang", "source").agg(*high, *low)


def judged_rows(docs: DataFrame, text: str = "text", reach: int = 3, min_group: int = 30) -> DataFrame:
    """``docs`` with ``COUNTS``, ``base_failed`` and ``kept``: measured for the sketches, then again beside the texts.

    Measuring twice is cheaper than storing the texts, or joining them by a key that rows may share.
    """
    narrow = stored(measured(docs, text, keep=["lang", "source"]), "measures")
    return judged(measured(docs, text), stored(fences(sketches(narrow), reach, min_group), "fences"))


def judged(rows: DataFrame, limits: DataFrame | None = None, reach: int = 3, min_group: int = 30) -> DataFrame:
    """``rows`` of ``measured`` with ``kept``, by ``limits`` or by the fences of ``rows`` themselves.

    Rows are read once for the fences and once for the result, so they should be stored.
    """
    if limits is None:
        limits = stored(fences(sketches(rows), reach, min_group), "fences")
    names = [f"{m}_high" for m in MEASURES] + [f"{m}_low" for m in LOWER_FENCED]
    columns = ["lang", "source"]
    every = limits.where("level = 0").select(F.struct(*names)).scalar()  # one row, or none if all texts failed
    group = limits.where("level = 2").select(
        *[F.col(c).alias(f"__{c}") for c in columns], F.struct(*names).alias("__group")
    )
    lang = limits.where("level = 1").select(F.col("lang").alias("__lang"), F.struct(*names).alias("__language"))
    same_lang = F.col("lang").eqNullSafe(F.col("__lang"))
    out = rows.join(group, same_lang & F.col("source").eqNullSafe(F.col("__source")), "left").drop("__lang", "__source")
    out = out.join(lang, same_lang, "left").drop("__lang")
    limit = F.coalesce("__group", "__language", every)
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & (measure_value(m) <= limit[f"{m}_high"])
    for m in LOWER_FENCED:
        inside = inside & (measure_value(m) >= limit[f"{m}_low"])
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return out.withColumn("kept", kept).drop("__group", "__language")
