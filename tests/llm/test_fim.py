import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightlens.llm import fim
from tests.llm.conftest import EDGE

MARKED = [(20, "a <P> b", "en", "a"), (21, "<S", "en", "a"), (22, "<<<>P><", "en", "a"), (23, "x<M>", "en", "a"), (24, "é€𝄞 abc", "en", "a"),
          (25, "\n\n\r a\u0000b", "en", "a"), (26, "Z", "en", "a"), (27, "ab" * 40_000 + "é", "en", "a")]


def brute(doc_id, text, plain=10, spm=20):
    """The definition, by one regular expression and joined strings."""
    t = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, t
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows(df):
    return sorted((repr(r.doc_id), r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.fim.output, r.fim.output_sha256) for r in df.collect())


def expected(data, **k):
    return sorted((repr(r[0]), *(b := brute(r[0], r[1], **k)), hashlib.sha256(b[4].encode()).hexdigest()) for r in data)


@pytest.mark.parametrize("shares", [{}, {"plain": 0, "spm": 0}, {"plain": 0, "spm": 100}])
def test_edge_rows_follow_the_definition(spark, edge, shares):
    marked = spark.createDataFrame(MARKED, "doc_id long, text string, lang string, source string")
    docs = edge.select("doc_id", "text", "lang", "source", "rank", "score").unionByName(marked, allowMissingColumns=True)
    out = fim.transform(docs.withColumn("fim", F.lit("old")), plain_percent=shares.get("plain", 10), spm_percent=shares.get("spm", 20))
    assert out.columns == ["doc_id", "text", "lang", "source", "rank", "score", "fim"]
    assert repr(rows(out)) == repr(expected([*EDGE, *MARKED], **shares))
    back = fim.restore(out, F.col("fim.output"), F.col("fim.form"))
    assert back.where(F.coalesce("text", F.lit("")) != F.col("restored")).count() == 0


def test_descriptors_point_into_text_and_sentinels(spark):
    docs = spark.createDataFrame([(i, f"word é{i} — ende") for i in range(60)], "doc_id long, text string")
    marks = "".join(fim.MARKS).encode()
    for r in fim.transform(docs).collect():
        buffers = {"text": r.text.encode(), "marks": marks}
        assert b"".join(buffers[p.buffer][p.start:p.start + p.length] for p in r.fim.pieces).decode() == r.fim.output
        assert len(r.fim.pieces) == (1 if r.fim.form == "plain" else 6)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB <>PSM\né𝄞", max_size=30).filter(lambda t: not any(m in t for m in fim.MARKS)), st.data())
def test_every_cut_is_undone(text, data):
    raw, own = [m.encode() for m in fim.MARKS], text.encode()
    cuts = [len(text[:i].encode()) for i in sorted(data.draw(st.lists(st.integers(0, len(text)), min_size=2, max_size=2)))]
    pieces = [(0, cuts[0]), (cuts[0], cuts[1] - cuts[0]), (cuts[1], len(own) - cuts[1])]
    for form in fim.ARRANGEMENTS:
        buffers = {"text": memoryview(own), "marks": memoryview(b"".join(raw))}
        out = b"".join(fim.stream(fim.arrange(pieces, form, raw), buffers))
        assert b"".join(fim.stream(fim.restored_pieces(out, form, raw), {"text": memoryview(out)})) == own


def test_other_sentinels(spark, nothing):
    docs = spark.createDataFrame([(1, "a⟨b"), (2, "one two")], "doc_id long, text string")
    out = fim.transform(docs, marks=("⟨1", "⟨2", "⟨3"), plain_percent=0)
    back = fim.restore(out, F.col("fim.output"), F.col("fim.form"), ("⟨1", "⟨2", "⟨3")).collect()
    assert all(r.restored == r.text and "⟨1" in r.fim.output for r in back)
    for bad in (("<a", "<a", "<b"), ("", "<a", "<b"), ("aa", "<b", "<c")):
        with pytest.raises(ValueError):
            fim.transform(docs, marks=bad)
    assert fim.transform(nothing).collect() == []


def test_an_output_without_its_sentinels_is_an_error(spark):
    df = spark.createDataFrame([("abc", "psm")], "o string, f string")
    with pytest.raises(Exception, match="subsection not found|not found"):
        fim.restore(df, F.col("o"), F.col("f")).collect()
