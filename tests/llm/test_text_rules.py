"""Toxicity, quality, licence and mixing operators."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freightlens.llm import licenses, mixing, quality, toxicity
from freightlens.llm.common import Scratch
from tests.llm.conftest import EDGE, prose

SPACE = re.compile(r"[\x20\x09-\x0D]+")


# ---------------------------------------------------------------- quality

def measures(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines),
            sum(a == b for a, b in zip(words, words[1:])))


def test_measures_equal_plain_python(spark, texts):
    rows = [(i, t) for i, t in enumerate([t[1] for t in texts] + [t[1] for t in EDGE] + ["a b c d e f g h " * 3, "x\nx\n \nx\r\ny", "# # |\n"])]
    df = spark.createDataFrame(rows, "i int, text string").repartition(2)
    out = df.select("i", quality.measure_column(F.col("text")).alias("m")).collect()
    assert {r.i: tuple(r.m) for r in out} == {i: measures(t) for i, t in rows}


def test_quality_edge_rows_and_empty_table(spark, edge, nothing):
    out = quality.judge(edge, Scratch(spark, "test"))
    assert out.columns == [*edge.columns, "quality_m", "quality_base_failed", "quality_kept"]
    rows = out.collect()
    assert len(rows) == len(EDGE)
    assert all(r.quality_base_failed and not r.quality_kept for r in rows if len((r.text or "").split()) < 20)
    assert quality.judge(nothing, Scratch(spark, "test")).count() == 0


def test_fences_follow_language_and_source(spark):
    """A share that is usual in one source is far above the fence of another."""
    rows = [(i, prose(50, i), "en", "plain") for i in range(60)]
    rows += [(100 + i, " ".join(w + "#" * (j % 2) for j, w in enumerate(prose(50, i).split())), "en", "code") for i in range(60)]
    rows += [(999, "# " * 10 + prose(40, 77), "en", "plain"), (998, "| " * 300 + prose(100, 78), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r.doc_id for r in quality.judge(df, Scratch(spark, "test")).where("not quality_kept").collect()}
    assert {999, 998} <= gone and len(gone - {999, 998}) <= 2


def test_a_clean_source_of_a_tenth_of_its_language_stays(spark):
    rows = [(i, prose(50, i), "en", "plain") for i in range(540)]
    rows += [(1000 + i, " ".join(w + "#" * (j % 2) for j, w in enumerate(prose(50, i).split())), "en", "code") for i in range(60)]
    rows += [(9999, "| " * 300 + prose(100, 78), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = quality.judge(df, Scratch(spark, "test")).where("not quality_base_failed")
    gone = {r.doc_id for r in judged.where("not quality_kept").collect()}
    assert not [i for i in gone if 1000 <= i < 1060]
    gone = {r.doc_id for r in quality.judge(df, Scratch(spark, "test")).where("not quality_kept").collect()}
    assert 9999 in gone


def kept_brute(rows):
    """``kept`` by exact quantiles over plain Python measures of ``rows(id, text, lang, source)``."""
    measured = [(*measures(t), g, s) for _, t, g, s in rows]
    ratios = lambda m: (m[2] / m[0], m[3] / max(1, m[5]), m[4] / m[0], m[6] / m[0], m[1] / m[0])
    low = lambda c, n: (c - 2 * c ** 0.5) / n
    good = [m for m in measured if m[0] >= 20 and 100 * m[4] <= 30 * m[0]]

    def fence(own):
        out = []
        for v in zip(*map(ratios, own), strict=True):
            upper, middle = (sorted(v)[max(0, math.ceil(p * len(v) - 1e-9) - 1)] for p in (0.9, 0.5))
            out.append(upper + 3 * (upper - middle))
        return out

    kept, known = [], {}
    for m in measured:
        if m not in good:
            kept.append(False)
            continue
        g, s = m[-2:]
        if (g, s) not in known:
            own, its = [x for x in good if x[-2:] == (g, s)], [x for x in good if x[-2] == g]
            w = 1 - math.exp(-len(own) / 15)
            known[g, s] = [w * a + (1 - w) * b for a, b in zip(fence(own), fence(its), strict=True)]
        bounds = (low(m[2], m[0]), low(m[3], max(1, m[5])), low(m[4] / 8, m[0] / 8), low(m[6], m[0]), m[1] / m[0])
        kept.append(all(b <= f + 1e-9 for b, f in zip(bounds, known[g, s], strict=True)))
    return kept


def test_kept_equals_exact_quantiles(spark, texts):
    """Up to some two hundred values a sketch is exact."""
    rows = [(i, t, g, s) for i, (_, t, g, s) in enumerate([*texts, *EDGE])]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3), Scratch(spark, "test"))
    got = {r.doc_id: r.quality_kept for r in got.collect()}
    want = kept_brute(rows)
    assert [got[i] for i in range(len(rows))] == want and 20 < sum(want) < len(rows)


@pytest.mark.parametrize("n", [1, 5, 19, 20, 21, 49, 50, 51, 300])
def test_fence_of_a_small_group_leans_on_its_language(spark, n):
    """One formula at every size: the fence moves from the language's to the group's own without a step."""
    rows = [(i, prose(50, i), "en", "plain") for i in range(200)]
    rows += [(1000 + i, " ".join(w + "#" for w in prose(50, i).split()), "en", "code") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    m = df.select("lang", "source", quality.measure_column(F.col("text")).alias("m"))
    got = {r.source: r.fence_symbols_per_word for r in quality.fences(Scratch(spark, "test").write(quality.sketches(m), "s")).collect()}
    its = 1.0 if n > 200 else 4.0 if n > 22 else 0.0  # the upper quantile is 1 once more than a tenth are code, the median once more than half are
    assert got["code"] == pytest.approx(1 - math.exp(-n / 15) + math.exp(-n / 15) * its)


def test_few_marks_say_little(spark):
    rows = [(i, prose(50, i), "en", "a") for i in range(60)] + [(100, prose(49, 70) + " ##", "en", "a"), (101, prose(40, 71) + " #" * 30, "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality.judge(df, Scratch(spark, "test")).where("not quality_kept").collect()] == [101]


def test_measures_run_twice_and_no_single_task(spark):
    plans = []

    class Seen(Scratch):
        def write(self, df, name):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return super().write(df, name)

    out = quality.judge(spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string"), Seen(spark, "test"))
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert sum("ArrowEvalPython" in p for p in plans) == 2 and not any("Repartition 1, false" in p for p in plans)


def test_clean_documents_stay_and_junk_goes(spark, con, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.quality_kept for r in quality.judge(df, Scratch(spark, "test")).collect()}
    label = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    clean = [kept[i] for i, q in label.items() if q == 1 and i in kept]
    junk = [kept[i] for i, q in label.items() if q == 0 and i in kept]
    assert np.mean(clean) > 0.95 and np.mean(junk) < 0.5


# ---------------------------------------------------------------- toxicity

def brute_segments(scores):
    """Maximal segments by their definition: repeatedly the best one, then left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (i, j, total)
    if best is None:
        return []
    i, j, s = best
    return brute_segments(scores[:i]) + [best] + [(a + j + 1, b + j + 1, t) for a, b, t in brute_segments(scores[j + 1:])]


def test_maximal_segments_equal_the_definition():
    rng = np.random.default_rng(5)
    for _ in range(200):
        scores = rng.normal(size=rng.integers(0, 25)).tolist()  # no ties
        got = toxicity.maximal_segments(scores)
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in brute_segments(scores)))
        assert [x[:2] for x in got] == [x[:2] for x in brute_segments(scores)]


def test_tokens_drop_punctuation():
    w = toxicity.tokens(pa.array(["You IDIOT, you!", None, "É-a"]))
    words = w.distinct.to_pylist()
    assert [words[c] for c in w.codes] == ["you", "idiot", "you", "é", "a"] and w.counts.tolist() == [3, 0, 2]


def toxic_table(spark):
    rows, labels = [], []
    for i in range(300):
        words = prose(80, i).split()
        bad = i % 5 == 0
        if bad:
            for at in (10, 14, 15, 22):
                words[at] = ["villain", "rotter"][(i + at) % 2]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_passages_are_found_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels.where(~toxicity.in_fold(F.col("doc_id"))))
    out = toxicity.score(docs, model).where(toxicity.in_fold(F.col("doc_id"))).collect()
    assert out and all((r.toxic_score >= 0.5) == (r.doc_id % 5 == 0) for r in out)
    for r in out:
        if r.doc_id % 5 == 0:
            assert any(s.first <= 10 and s.last >= 15 or s.first == 10 for s in r.toxic_found.segments)


def test_toxicity_edge_rows(spark, edge, nothing):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.toxic_score < 0.5 for r in rows)
    assert toxicity.score(nothing, model).count() == 0
    one = toxicity.fit(edge, labels.where("toxic = 0"))
    assert all(r.toxic_score < 0.5 for r in toxicity.score(edge, one).collect())
    none = toxicity.fit(nothing, spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    assert all(r.toxic_score < 0.5 for r in toxicity.score(edge, none).collect())


def test_held_out_accuracy_on_driver_labels(spark, con, texts):
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame(con.sql("SELECT doc_id, toxic FROM labels").fetchall(), "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    label = {r.doc_id: r.toxic for r in labels.collect()}
    wrong = [r.doc_id for r in toxicity.score(docs, model).collect() if r.doc_id in label and (r.toxic_score >= 0.5) != (label[r.doc_id] == 1)]
    assert len(wrong) <= 0.05 * len(label)


def test_segments_of_a_long_text_take_linear_time():
    """Rising and falling scores leave many open segments; the former walk back took minutes for these."""
    import time

    rng = random.Random(1)
    for scores in ([0.5 if i % 2 else -0.4 for i in range(400_000)], [1.0 if i % 2 else -1.5 for i in range(400_000)],
                   [rng.choice([2.0, -2.1]) for _ in range(400_000)], [x for i in range(200_000) for x in (1.0 + i % 7, -8.0)]):
        began = time.perf_counter()
        found = toxicity.maximal_segments(scores)
        assert time.perf_counter() - began < 15 and found


# ---------------------------------------------------------------- licences

def license_brute(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    cut = lambda x: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", x) if w]
    words = cut(low)
    places, base = [], set()
    for p, label in licenses.PHRASES.items():
        p = p.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    own, best = set(), 0.0
    for label, notice in licenses.TEMPLATES:
        t, width = set(notice.split()), -(-len(notice.split()) * 100 // licenses.PERCENT)
        if len(t & set(words)) * 100 < licenses.PERCENT * len(t):
            continue
        most = max(len(t & set(words[i:i + width])) for i in range(len(words)))  # over all blocks of so many words
        if 100 * most >= licenses.PERCENT * len(t):
            own.add(label)
            best = max(best, most / len(t))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)),
            1.0 if places else best)


LICENSED = ["", None, "MIT License mit license MIT-license", "cc by cc by gnu general public license", "Released under the\nMIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files.",
            "x\nLicensed under CC-BY-NC 4.0.\ny apache  license", "mit élicense license mit", "commit licenses", "License Apache the under licensed 2 0"]


def test_license_scan_equals_brute_force(spark, texts):
    rows = [(i, t) for i, t in enumerate(LICENSED + [t[1] for t in EDGE] + [t[1] for t in texts])]
    rows += [rows[2], (None, "mit license"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as labels", "1 as hash", "2 as line").repartition(3)
    got = sorted(map(repr, (tuple(r[:8]) for r in licenses.scan(df).collect())))
    assert got == sorted(repr((i, *license_brute(t))) for i, t in rows)


def test_phrases_are_found_beyond_line_separators(spark):
    rows = list(enumerate(["a\u0085 b mit license", "x \u2028 mit license \u0085 y\u2029 cc by z", "mit license \u2029 apache license", "\u2028 cc by"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r[:8]) for r in licenses.scan(df).collect())
    assert got == [(i, *license_brute(t)) for i, t in rows]


def test_wrapped_and_scattered_notices_equal_brute_force_and_sql(spark):
    """Where lines and blocks differ: notices over lines, cut, mixed with other words, or scattered."""
    rows = []
    for i, (_, notice) in enumerate(licenses.TEMPLATES):
        w = notice.split()
        rows += [(10 * i, "\n".join(" # " + " ".join(w[j:j + 4]) for j in range(0, len(w), 4))), (10 * i + 1, " ".join(f"{x} {prose(40, j)}" for j, x in enumerate(w))),
                 (10 * i + 2, prose(90, i) + "\n" + " ".join(w[:-(len(w) // 6) or None]) + " " + prose(30, i)), (10 * i + 3, " x ".join(w)),
                 (10 * i + 4, " ".join(x + (" y" if j % 4 == 3 else "") for j, x in enumerate(w))), (10 * i + 5, " ".join(w[:len(w) // 2]) + "\n" + prose(300, i) + " ".join(w[len(w) // 2:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r[:8]) for r in licenses.scan(df).collect())
    assert got == sorted((i, *license_brute(t)) for i, t in rows)
    import duckdb

    c = duckdb.connect()
    c.register("documents", df.toPandas())
    from freightlens.llm.oracle import license_sql
    assert sorted(c.sql(license_sql()).fetchall()) == got
    assert 8 < sum(bool(r[6]) for r in got) < len(got) - 8


def test_notices_cross_lines_and_scattered_words_are_none(spark):
    notices = {label: t for label, t in licenses.TEMPLATES if label in ("mit", "bsd", "mpl-2.0", "gpl-2.0")}
    rows = []
    for i, (label, notice) in enumerate(notices.items()):
        w = notice.split()
        wrapped = "\n".join(" * " + " ".join(w[j:j + 5]) for j in range(0, len(w), 5))
        far = " ".join(f"{x} {prose(40, j)}" for j, x in enumerate(w))
        rows += [(10 * i, wrapped, label, 1.0), (10 * i + 1, prose(200, i) + "\n" + wrapped + "\n" + prose(90, i), label, 1.0), (10 * i + 2, far, "", 0.0)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(df).collect()}
    want = {i: ("gpl,gpl-2.0" if label == "gpl-2.0" else label, score) for i, _, label, score in rows}
    assert got == want


def test_license_empty_table(nothing):
    assert licenses.scan(nothing).count() == 0


# ---------------------------------------------------------------- mixing

def test_counts_follow_the_weights(spark):
    rows = [(i, "x" * 50, "en", "big" if i % 10 else "small") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.replicate(df, {"small": 0.5}, Scratch(spark, "test"))
    n = {r.source: r.n for r in out.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(n["small"] / 10_000 - 1) < 0.05 and abs(n["big"] / 10_000 - 1) < 0.05
    counts = Counter(r.copies for r in out.where("source = 'small' and copy = 1").collect())
    assert abs(counts[5] / 2000 - 0.1755) < 0.03  # Poisson(5)


def test_large_means_are_sums_of_parts(spark):
    df = spark.createDataFrame([(1, "x", "en", "tiny")] + [(i, "x" * 1000, "en", "big") for i in range(2, 6)], "doc_id long, text string, lang string, source string")
    out = mixing.replicate(df, {"tiny": 0.5}, Scratch(spark, "test")).where("source = 'tiny'")
    assert abs(out.count() - 2000) < 6 * 45


def test_mixing_edge_rows_and_repeatability(spark, edge, nothing):
    a = mixing.replicate(edge, {"a": 0.5}, Scratch(spark, "test"), epochs=3)
    b = mixing.replicate(edge.repartition(7), {"a": 0.5}, Scratch(spark, "test"), epochs=3)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert set(a.columns) == {*edge.columns, "copy", "copies", "shuffle_key"}
    assert all(1 <= r.copy <= r.copies for r in a.collect())
    assert mixing.replicate(nothing, {}, Scratch(spark, "test")).count() == 0
