"""Each stage of the pipeline against brute force on what the one before kept."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from freightlens.llm import mixing
from freightlens.llm.common import Scratch
from tests.llm.conftest import SF
from tests.llm.test_minhash import brute as components
from tests.llm.test_tokens import covered, crc, ids_of


@pytest.fixture(scope="module")
def stages(spark, con):
    """Rows of every stage, each from the written result of the one before."""
    scratch, out = Scratch(spark, "test-pipeline"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = scratch.write(stage(spark, docs, SF), name)
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_stages_are_those_of_the_plan(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_dedup", "mix_sources", "packing"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_filters_keep_clean_documents(stages, con):
    label = {i: (q, t) for i, q, t in con.sql("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    whole, first, second = ({r[0]: r for r in rows(stages[n])} for n in ("documents", "toxicity", "quality_rules"))
    assert all(whole[i] == r for i, r in first.items()) and all(first[i] == r for i, r in second.items())
    clean = [i for i, (_, t) in label.items() if t == 0]
    toxic = [i for i, (_, t) in label.items() if t == 1]
    assert sum(i in first for i in clean) >= 0.97 * len(clean) and sum(i in first for i in toxic) <= 0.5 * len(toxic)  # nine examples to learn from
    good = [i for i in first if label.get(i, (0, 1))[0] == 1 and len(first[i][1].split()) >= 20]
    assert sum(i in second for i in good) >= 0.95 * len(good)


def test_one_document_of_each_group_stays(stages):
    before = rows(stages["quality_rules"])
    want = sorted(i for i, _, c in components(before, 5) if i == c)
    assert sorted(repr(r[0]) for r in rows(stages["near_dedup"])) == want


def poisson(mean, u):
    parts = max(1, math.ceil(mean / mixing.PART))
    total = 0
    for draw in u(parts):
        p = cdf = math.exp(-mean / parts)
        k = 0
        while cdf < draw:
            k += 1
            p = p * (mean / parts) / k
            cdf += p
        total += k
    return total


def test_copies_follow_the_poisson_counts(stages):
    before, after = rows(stages["near_dedup"]), Counter(rows(stages["mix_sources"]))
    size = defaultdict(int)
    for _, text, _, source in before:
        size[source] += len(text)
    total = sum(size.values())
    taken = sum(w for s, w in mixing.WEIGHTS.items() if s in size)
    rest = (1 - taken) / sum(s not in mixing.WEIGHTS for s in size)
    for r in before:
        mean = mixing.WEIGHTS.get(r[3], rest) * total / size[r[3]]
        draws = lambda parts, i=r[0]: [(int(hashlib.md5(f"{mixing.SEED}:{p}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                                       for p in range(1, parts + 1)]
        assert after[r] == poisson(mean, draws)
    assert sum(after.values()) == sum(after[r] for r in before)


def test_packing_holds_every_id_of_every_copy(stages):
    texts = rows(stages["mix_sources"])
    pieces = stages["packing"].collect()
    covered(pieces, texts)
    copies = Counter(t[0] for t in texts)
    by_doc = {t[0]: t[1] for t in texts}
    got = defaultdict(int)
    for r in pieces:
        ids = ids_of(by_doc[r.doc_id])
        assert r.doc_tokens == len(ids) and crc(ids[r.start:r.start + r.length]) == crc([int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)])
        got[r.doc_id] += r.length
    assert all(got[i] == n * len(ids_of(by_doc[i])) for i, n in copies.items())


def test_pipeline_is_registered_and_runs_on_empty_documents(spark, con, tmp_path):
    assert E.queries()["pipeline"] is corpus_pipeline.run
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
