import math
import random
import re

import pytest

from freightlens.llm import term_pipeline as tp
from freightlens.llm.common import Scratch
from tests.llm.conftest import EDGE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    """Every score of every item and row, by the definition."""
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, w, {t: w.count(t) for t in set(w)}) for d, w in bags if w]
    n_docs, n_all = len(bags), sum(len(w) for _, w, _ in bags)
    out = []
    for item, text in items:
        own = set(terms(text))
        df = {t: sum(t in c for _, _, c in bags) for t in own}
        found = []
        for d, w, c in bags:
            m = 100 - 50 + (50 * len(w) * n_docs) // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


ITEMS = [(1, "Alpha38 beta, TAIL one"), (2, ""), (3, None), (4, "é x Y\u0085"), (None, "tail tail"), (1, "one"), (5, "unknownword"), (6, " ".join(EDGE[0][1].split()[:30]))]


def test_edge_rows(spark, edge):
    docs = [(r[0], r[1]) for r in EDGE if r[0] != 8]
    items = spark.createDataFrame([(*i, 7) for i in ITEMS], "item_id long, text string, score int")
    out = tp.search(edge.where("doc_id IS NULL OR doc_id <> 8"), items, Scratch(spark, "search"), k=3)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(out) == brute(docs, ITEMS, 3)


@pytest.mark.parametrize("k, shard, stages", [(1, 200, tp.STAGES), (5, 3000, tp.STAGES), (5, 1 << 20, ()), (500, 3000, (2000,))])
def test_stages_shards_and_bounds_lose_nothing(spark, k, shard, stages):
    """Zipf-like texts, groups of copies and a word in every text; small shards make the bounds work."""
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)]
    heavy = [1 / (i + 1) for i in range(300)]
    docs = [(i, "common " + " ".join(rng.choices(words, heavy, k=rng.choice([3, 20, 80])))) for i in range(240)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(120)]
    items = [(i, "common " + " ".join(rng.choices(words, k=12))) for i in range(12)] + [(90, docs[0][1]), (91, "common"), (92, "w299 w298")]
    out = tp.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"),
                    Scratch(spark, "search"), k=k, stages=stages, shard_bytes=shard)
    assert got(out) == brute(docs, items, k)


def test_later_stages_carry_few_accumulators(spark, tmp_path):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, f"the of rare{i % 200} " + " ".join(rng.choices(["and", "to", "in", "a"], k=9))) for i in range(2000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the of rare7 and to")], "item_id long, text string")
    kept = []

    class Watching(Scratch):
        def write(self, df, name):
            out = super().write(df, name)
            if name.startswith("stage-") and name != "stage-0":
                kept.append(out.selectExpr("coalesce(sum(size(docs)), 0) AS n").first().n)
            return out

    assert len(tp.search(docs, items, Watching(spark, "search"), k=5).collect()) == 5
    assert max(kept) <= 40


def test_filter_is_exact_for_its_terms(spark):
    terms_ = [f"t{i}" for i in range(500)] + ["é"]
    bits = tp.term_filter(spark.createDataFrame([(t,) for t in terms_], "term string"))
    import numpy as np
    at = tp._bits(np.array(terms_, dtype=object))
    assert bits[at].all() and bits.sum() == len(set(at.tolist()))


def test_empty(spark, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert tp.search(nothing, items, Scratch(spark, "search")).collect() == []
    assert tp.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0), Scratch(spark, "search")).collect() == []
