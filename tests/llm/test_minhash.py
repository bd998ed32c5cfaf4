import re

import numpy as np
import pyarrow as pa

from freightlens.llm import minhash
from freightlens.llm.common import Scratch, Words, connected_components, shingle_sets
from tests.llm.conftest import EDGE, prose


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if len(words) < n:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent=80):
    """Size and component of each row by comparing all pairs."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = [(r[0], shingles(r[1], n)) for r in rows]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in sets:
        for y, b in sets:
            if x is not None and y is not None and x < y and a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(x), find(y)))
                parent[hi] = lo
    return sorted((repr(i), len(s), repr(None if i is None else find(i))) for i, s in sets)


def got(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def test_sets_of_a_batch_equal_single_sets():
    texts = ["A b  c", None, "", "x", " lead trail ", "a b a b a b", "É é"]
    for n in (1, 2, 5):
        _, offsets = shingle_sets(Words(pa.array(texts)), n)
        assert np.diff(offsets).tolist() == [len(shingles(t, n)) for t in texts]


def test_min_and_max_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    lo, hi = minhash.minmax(np.concatenate([a, b]), np.array([0, 900, 1800]), 2000)
    assert abs((lo[0] == lo[1]).mean() - 0.8) < 0.04 and abs((hi[0] == hi[1]).mean() - 0.8) < 0.04


def test_edge_rows(edge):
    assert got(minhash.near_duplicates(edge, 2)) == brute(EDGE, 2)
    out = minhash.near_duplicates(edge, 5).collect()
    assert got(minhash.near_duplicates(edge, 5)) == brute(EDGE, 5)
    assert all(r.kept for r in out if r.doc_id is None or not r.n_shingles)


def test_dropping_keeps_one_of_each_group_and_all_columns(edge):
    out = minhash.drop_near_duplicates(edge)
    assert out.columns == edge.columns
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == [1, 4, 5, 6, 7, 8, 9, 11]
    assert out.where("doc_id is null").count() == 2


def test_an_id_with_several_texts_loses_none(spark):
    a, b, c, x = (prose(60, k) for k in (1, 2, 3, 4))
    rows = [(1, a), (1, b), (2, b), (2, x), (3, c), (3, c), (4, x + " end"), (None, b), (5, ""), (5, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted((repr(r.doc_id), r.text or "-") for r in minhash.drop_near_duplicates(df).collect())
    assert left == sorted([("1", a), ("1", b), ("2", x), ("3", c), ("None", b), ("5", "-"), ("5", "-")])
    out = {(r.doc_id, r.text_hash): r.component_id for r in minhash.grouped(df).collect() if r.doc_id}
    h = {r.text: r.h for r in spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "xxhash64(text) AS h").collect()}
    assert (out[2, h[b]], out[2, h[x]], out[4, h[x + " end"]], out[1, h[a]], out[3, h[c]]) == (1, 2, 2, 1, 3)
    plain = spark.createDataFrame([(1, a), (1, b), (2, b), (3, c)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in minhash.drop_near_duplicates(plain).collect()) == sorted([(1, a), (1, b), (3, c)])


def test_confirming_a_hub_of_many_pairs_over_many_batches(spark):
    base = prose(120, 5)
    texts = [(0, base)] + [(i, base + f" w{i}" if i % 3 else prose(90, i)) for i in range(1, 3000)]
    pairs = [(0, i) for i in range(1, 3000)] + [(1, 2), (3, 6), (2, 7)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = minhash.confirm(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(texts, "doc_id long, text string"), 5, 80)
        found = sorted((r.a, r.b) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    sets = dict(texts)
    near = lambda a, b: (lambda x, y: 100 * len(x & y) >= 80 * len(x | y))(shingles(sets[a], 5), shingles(sets[b], 5))
    assert found == sorted(p for p in pairs if near(*p)) and 1000 < len(found) < 2500


def test_empty_table(nothing):
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.drop_near_duplicates(nothing).count() == 0


def test_groups_of_near_copies_with_borderline_pairs(spark):
    """A chain whose ends are far apart, and a group of many different copies."""
    rng = np.random.default_rng(3)
    base = prose(150, 2).split()
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, len(words), 5):
            words[at] = f"w{rng.integers(1000)}"
        rows.append((i, " ".join(words), "en", "a"))
    chain = prose(200, 6).split()
    for i in range(10):
        rows.append((500 + i, " ".join(chain[i * 8:i * 8 + 120]), "en", "a"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert got(minhash.near_duplicates(df, 2)) == brute(rows, 2)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = dict(connected_components(df, Scratch(spark, "test"), "t").collect())
    assert all(label[i] == 0 for i in range(41)) and all(label[100 + i] == 100 for i in range(30))


def test_driver_documents(spark, con, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    assert got(minhash.near_duplicates(df, 2)) == brute(texts, 2)
