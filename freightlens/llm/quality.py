"""Quality rules with thresholds learned per language and source.

One pass computes each text's measures.  KLL sketches of every share are built
per (lang, source) over the texts that pass the base rule - partial sketches are
merged, so a hot source is one sketch per task - and written once.  Their
quantiles give a group's fence: the upper one (``UPPER``) plus ``SPREAD`` times
its distance from the median.  No cutoff is fixed for any share.

A group of m such texts takes 1 - exp(-m / ``LEAN``) of its own fence and the rest
from its language's, whose sketches are the same ones merged further.  The fences
are joined back on (lang, source).  A share of few words or lines says little: a
text is rejected where its count less ``SIGMA`` standard errors (those of a
Poisson count) is still above the fence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import STEP, U64, Scratch, Words, mix, slices, utf8_parts

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_echo_words long"
SHARES = ("symbols_per_word", "dup_line_share", "repeat_word_share", "echo_word_share", "chars_per_word")
UPPER = 0.9
SPREAD = 3.0
LEAN = 15
SIGMA = 2.0



def _repeats(words: Words) -> np.ndarray:
    """Per text the words inside 8-word windows that occur at least twice in it."""
    n, codes = len(words.codes), words.codes.astype(U64)
    if n < WINDOW:
        return np.zeros(len(words), dtype=np.int64)
    code = mix(codes + U64(1))
    h = np.zeros(n - WINDOW + 1, dtype=U64)
    for j in range(WINDOW):
        h = mix(h * STEP + code[j:n - WINDOW + 1 + j])
    row = words.rows()
    inside = row[:len(h)] == row[WINDOW - 1:]
    start, row = np.flatnonzero(inside), row[:len(h)][inside]
    h = mix(h[inside] + row.astype(U64) * STEP)  # windows of different texts differ
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), dtype=bool)
    equal = h[order][1:] == h[order][:-1]
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, start[same], 1)
    np.add.at(cover, start[same] + WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:-1] > 0)))
    return covered[words.offsets[1:]] - covered[words.offsets[:-1]]


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the lines with a word, and those equal to an earlier line."""
    split = pc.split_pattern(texts, "\n")
    ends = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    codes = flat.dictionary_encode()
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(codes.dictionary)), 0).to_numpy(zero_copy_only=False)
    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keep = full[code] if len(full) else np.zeros(0, dtype=bool)
    row, code = row[keep], code[keep]
    lines = np.bincount(row, minlength=len(texts))
    distinct = np.unique(row * max(1, len(full)) + code) // max(1, len(full))
    return lines, lines - np.bincount(distinct, minlength=len(texts))


def measure_column(text: Column) -> Column:
    """``MEASURES`` of a text column; a null text is empty.

    Words are runs without space and U+0009-U+000D.  ``n_dup_lines``: lines
    (split at \\n) with a word that equal an earlier line; ``n_repeat_words``:
    words in 8-word windows found at least twice in the text; ``n_echo_words``:
    words equal to the word before.
    """

    @F.arrow_udf(MEASURES)
    def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        symbol = np.zeros(256, dtype=bool)
        symbol[list(SYMBOLS)] = True
        for part in parts:
            out = []
            for b in slices([pa.record_batch([part], names=["text"])], "text"):
                texts = pc.fill_null(b.column("text").cast(pa.string()), "")
                words = Words(texts, lower=False)
                length = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False)
                chars = np.concatenate(([0], np.cumsum(length[words.codes]))) if len(length) else np.zeros(1, dtype=np.int64)
                at, data = utf8_parts(texts)
                marks = np.concatenate(([0], np.cumsum(symbol[data], dtype=np.int32)))
                lines, dups = _lines(texts)
                row = words.rows()
                echo = row[1:][(words.codes[1:] == words.codes[:-1]) & (row[1:] == row[:-1])]
                out.append((words.counts, np.diff(chars[words.offsets]), np.diff(marks[at]), dups, _repeats(words), lines,
                            np.bincount(echo, minlength=len(words))))
            columns = [pa.array(np.concatenate([o[k] for o in out]) if out else [], pa.int64()) for k in range(7)]
            yield pa.StructArray.from_arrays(columns, names=[c.split()[0] for c in MEASURES.split(", ")])

    return measure.asNondeterministic()(text)


def _counted(m: Column) -> dict[str, tuple[Column, Column]]:
    """Per share what is counted and out of how many."""
    one = F.lit(1)
    words, lines = F.greatest(m["n_words"], one), F.greatest(m["n_lines"], one)
    return dict(zip(SHARES, ((m["n_symbols"], words), (m["n_dup_lines"], lines), (m["n_repeat_words"] / WINDOW, words / WINDOW),
                             (m["n_echo_words"], words), (m["word_chars"], words)), strict=True))


def shares(m: Column) -> dict[str, Column]:
    return {k: count / of for k, (count, of) in _counted(m).items()}


def lower_bounds(m: Column) -> dict[str, Column]:
    """The shares less ``SIGMA`` standard errors; the mean word length as it is."""
    return {k: count / of if k == "chars_per_word" else (count - SIGMA * F.sqrt(count)) / of for k, (count, of) in _counted(m).items()}


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, n`` and a sketch per share of ``measured(lang, source, m)``,
    over the texts that pass the base rule; a null language or source is a group
    of its own."""
    good = measured.where(~base_failed(F.col("m"))).select("lang", "source", *[v.alias(k) for k, v in shares(F.col("m")).items()])
    return good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(k).alias(k) for k in SHARES])


def fences(group: DataFrame) -> DataFrame:
    """``lang, source, fence_<share>`` from ``sketches``."""
    language = group.groupBy(F.col("lang").alias("its")).agg(*[F.kll_merge_agg_double(k).alias(f"of_{k}") for k in SHARES])

    def fence(sketch: str) -> Column:
        upper, middle = (F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(p)) for p in (UPPER, 0.5))
        return upper + SPREAD * (upper - middle)

    own = 1 - F.exp(-F.col("n") / LEAN)
    return (group.join(language, F.col("lang").eqNullSafe(F.col("its")))
            .select("lang", "source", *[(own * fence(k) + (1 - own) * fence(f"of_{k}")).alias(f"fence_{k}") for k in SHARES]))


def judge(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs(..., text, lang, source)`` with ``quality_m`` (``MEASURES``),
    ``quality_base_failed`` and ``quality_kept``.

    A text is kept if the base rules hold and no share's lower bound is above its
    group's fence.  Null or empty texts fail the base rule; null languages and sources
    are groups of their own; repeated rows are judged alike; columns of these
    three names are replaced, others stay; an empty table stays empty.
    """
    own = ("quality_m", "quality_base_failed", "quality_kept")
    docs = docs.select(*[c for c in docs.columns if c not in own])
    measured = docs.select("lang", "source", measure_column(F.col("text")).alias("m"))
    group = scratch.write(sketches(measured), "sketches")
    limits = scratch.write(fences(group), "fences")  # a row per group: the planner sees its size
    names = [f"fence_{k}" for k in SHARES]
    limits = limits.select(F.struct("lang", "source", *names).alias("__fence"))
    rows = docs.withColumn("quality_m", measure_column(F.col("text")))
    rows = rows.join(limits, rows["lang"].eqNullSafe(F.col("__fence.lang")) & rows["source"].eqNullSafe(F.col("__fence.source")), "left")
    above = [F.coalesce(v > F.col(f"__fence.fence_{k}"), F.lit(False)) for k, v in lower_bounds(F.col("quality_m")).items()]
    failed = base_failed(F.col("quality_m"))
    verdict = ~failed
    for a in above:
        verdict = verdict & ~a
    return rows.withColumn("quality_base_failed", failed).withColumn("quality_kept", verdict).drop("__fence")
