"""Toxic passages by maximum-scoring segments over token log-odds.

1. Document frequencies of every token among the labelled toxic and clean
   texts, and of the candidates over all documents, are counted on Spark.
   Log-odds of toxic against clean with an informative Dirichlet prior (the
   whole corpus) give a z-value per token; tokens of high z score their
   log-odds, all others a small negative drift.
2. All maximal scoring segments (Ruzzo and Tompa, linear time) of each text.
3. Extreme-value statistics: a segment of score S has E = K n exp(-lambda S)
   chance equals in a text of n words, with lambda from the corpus' token
   distribution and K from clean documents.  A text's evidence is the sum
   of -ln E over its significant segments (E < 1), on a log scale; a logistic
   curve fitted on the labelled texts turns it into a probability.

The labelled sample is bounded by ``TRAIN_ROWS`` (chosen by hash), which bounds
the model: its ids and the lexicon are the only things sent to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import Words, from_parts, slices, utf8_parts

TRAIN_ROWS = 200_000
MIN_DOCS = 4  # toxic documents that hold a token of the lexicon
MIN_Z = 3.0
DRIFT = -0.2
MIN_SCORE = 1.0

SEGMENTS = "n_words long, segments array<struct<first: long, last: long, score: double>>"

_PLAIN = np.arange(256, dtype=np.uint8)  # ASCII other than letters, digits and apostrophes becomes a space
_PLAIN[[i for i in range(128) if not chr(i).isalnum() and i != 39]] = 32


def tokens(texts: pa.Array) -> Words:
    """Lower-case words without ASCII punctuation."""
    offsets, data = utf8_parts(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")))
    return Words(from_parts(offsets, _PLAIN[data]), lower=False)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence.

    Each open segment links to the nearest earlier one with a smaller total
    before it, so the segments between are passed over at once: linear time.
    """
    first: list[int] = []
    last: list[int] = []
    left: list[float] = []  # total before the segment
    right: list[float] = []  # total at its end
    link: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        if s > 0:
            start, before, after = i, total, total + s
            j = len(first) - 1
            while True:
                while j >= 0 and left[j] >= before:
                    j = link[j]
                if j < 0 or right[j] >= after:
                    break
                start, before, up = first[j], left[j], link[j]  # joined with all from there on
                for x in (first, last, left, right, link):
                    del x[j:]
                j = up
            for x, v in zip((first, last, left, right, link), (start, i, before, after, j), strict=True):
                x.append(v)
        total += s
    return [(a, b, r - l) for a, b, l, r in zip(first, last, left, right, strict=True)]


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0  # lambda
    k: float = 1.0
    intercept: float = -5.0
    slope: float = 0.0


def sample_frequencies(sample: DataFrame) -> DataFrame:
    """``token, n_toxic, n_clean`` over the labelled texts ``sample(text, toxic)``:
    documents that hold the token, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words = tokens(b.column("text"))
            row, code = _holders(words)
            toxic = b.column("toxic").to_numpy(zero_copy_only=False)[row]
            n = [np.bincount(code[toxic == k], minlength=len(words.distinct)) for k in (1, 0)]
            seen = (n[0] + n[1]) > 0
            yield pa.RecordBatch.from_arrays([words.distinct.filter(pa.array(seen)), *[pa.array(x[seen], pa.int64()) for x in n]],
                                             names=["token", "n_toxic", "n_clean"])

    counts = sample.select("text", "toxic").mapInArrow(count, "token string, n_toxic long, n_clean long")
    return counts.groupBy("token").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def corpus_frequencies(docs: DataFrame, candidates: list[str]) -> tuple[dict[str, int], int]:
    """Documents of the whole corpus that hold each candidate, and the number of
    (document, token) pairs at all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(candidates, pa.string())
        total, n = 0, np.zeros(len(candidates), dtype=np.int64)
        for b in slices(batches, "text"):
            words = tokens(b.column("text"))
            _, code = _holders(words)
            which = pc.fill_null(pc.index_in(words.distinct, names), -1).to_numpy(zero_copy_only=False)[code]
            n += np.bincount(which[which >= 0], minlength=len(candidates))
            total += len(code)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *seen], pa.int64()), pa.array([total, *n[seen]], pa.int64())], names=["i", "n"])

    rows = docs.select("text").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    return {candidates[r.i]: r.n for r in rows if r.i >= 0}, sum(r.n for r in rows if r.i < 0)


def _holders(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, token) pairs."""
    v = max(1, len(words.distinct))
    pair = np.unique(words.rows() * v + words.codes)
    return pair // v, pair % v


def segment_column(text: Column, lexicon: dict[str, float]) -> Column:
    """``SEGMENTS`` of a text column: its words and maximal segments by word number."""

    @F.arrow_udf(SEGMENTS)
    def segments(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = pa.array(list(lexicon), pa.string())
        values = np.array([*lexicon.values(), DRIFT])
        for part in parts:
            out, sizes = [], []
            for b in slices([pa.record_batch([part], names=["text"])], "text"):
                words = tokens(b.column("text"))
                which = pc.fill_null(pc.index_in(words.distinct, names), -1).to_numpy(zero_copy_only=False)
                hits = np.flatnonzero(which[words.codes] >= 0)
                row = np.searchsorted(words.offsets, hits, side="right") - 1
                found: list[list[dict]] = [[] for _ in range(len(words))]
                for r in np.unique(row):
                    places = hits[np.searchsorted(row, r):np.searchsorted(row, r, side="right")]
                    at = places - words.offsets[r]
                    scores, gaps = values[which[words.codes[places]]], np.diff(at) - 1
                    line = np.empty(2 * len(at) - 1)
                    line[::2], line[1::2] = scores, gaps * DRIFT
                    found[r] = [{"first": int(at[i // 2]), "last": int(at[j // 2]), "score": float(s)} for i, j, s in maximal_segments(line.tolist())]
                out += found
                sizes += words.counts.tolist()
            kind = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(out, pa.list_(kind))], names=["n_words", "segments"])

    return segments.asNondeterministic()(text)


def evidence(found: Column, model: Model) -> Column:
    """ln(1 + x), x the sum of -ln E over the segments with E < 1."""
    return F.log1p(F.aggregate(found["segments"], F.lit(0.0), lambda acc, s: acc + F.greatest(
        F.lit(0.0), F.lit(model.decay) * s["score"] - F.log(F.lit(model.k)) - F.log(found["n_words"].cast("double")))))


def _lexicon(counts: list[tuple[str, int, int]], n_all: dict[str, int], n_toxic: int, n_clean: int, n_docs: int,
             pairs: int) -> tuple[dict[str, float], float]:
    """Scores of the tokens of the lexicon, and lambda."""
    nt, nc = float(n_toxic), float(n_clean)
    lexicon, parts = {}, []
    for token, toxic, clean in counts:
        share = n_all[token] / n_docs  # the prior: as many documents as the sample has, distributed as the corpus
        at, ac = share * nt, share * nc
        odds = lambda y, a, n: math.log((y + a) / (2 * n - y - a + 0.5))
        value = odds(toxic, at, nt) - odds(clean, ac, nc)
        if value >= MIN_SCORE and value / math.sqrt(1 / (toxic + at) + 1 / (clean + ac)) >= MIN_Z:
            lexicon[token] = value
            parts.append((n_all[token] / max(1, pairs), value))
    rest = 1.0 - sum(p for p, _ in parts)
    # lambda: the positive root of sum p exp(lambda s) = 1
    lo, hi = 1e-6, 50.0
    if not parts or sum(p * s for p, s in parts) + rest * DRIFT >= 0:
        return lexicon, 1.0
    for _ in range(80):
        mid = (lo + hi) / 2
        value = sum(p * math.exp(min(700.0, mid * s)) for p, s in parts) + rest * math.exp(mid * DRIFT)
        lo, hi = (mid, hi) if value < 1 else (lo, mid)
    return lexicon, lo


def _logistic(groups: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic curve; ``groups``: evidence, clean, toxic."""
    x = np.array([[1.0, g[0]] for g in groups])
    clean, toxic = (np.array([g[k] for g in groups], dtype=float) for k in (1, 2))
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - (clean + toxic) * p) - 1e-3 * w
        hessian = (x * ((clean + toxic) * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(0.0, w[1]))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``labels(doc_id, toxic)`` and all of ``docs(doc_id, text)``.

    Rows with a null id or label are not used; of several labels for an id the
    largest counts.  Without toxic or clean examples the model scores every
    text alike, below one half.
    """
    labels = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = labels.count()
    share = min(1.0, train_rows / max(1, n))
    sample = labels.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    counts = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Model()
    sample = F.broadcast(sample)  # at most about ``train_rows`` ids
    docs = docs.select("doc_id", "text")
    labelled = docs.join(sample, "doc_id")
    found = sample_frequencies(labelled).where(F.col("n_toxic") >= MIN_DOCS)
    found = found.where(F.col("n_toxic") * counts[0] > 2 * F.col("n_clean") * counts[1])  # others can't reach MIN_SCORE
    known = [tuple(r) for r in found.orderBy("token").collect()]
    n_all, pairs = corpus_frequencies(docs, [t for t, _, _ in known])
    lexicon, decay = _lexicon(known, n_all, counts[1], counts[0], docs.count(), pairs)
    model = Model(lexicon, decay)
    if not lexicon:
        return model
    # K: clean words see K exp(-lambda s) segments of score s or more per word
    found = labelled.select("toxic", segment_column(F.col("text"), lexicon).alias("f")).persist()
    least = min(lexicon.values())
    clean = found.where("toxic = 0").agg(F.sum("f.n_words"), F.sum(F.size(F.filter("f.segments", lambda s: s["score"] >= least)))).first()
    model.k = max(1e-9, ((clean[1] or 0) + 0.5) * math.exp(decay * least) / max(1, clean[0] or 0))
    groups = (found.select("toxic", F.round(evidence(F.col("f"), model), 2).alias("x"))
              .groupBy("x").agg(F.sum(F.lit(1) - F.col("toxic")), F.sum("toxic")).collect())
    found.unpersist()
    model.intercept, model.slope = _logistic([tuple(r) for r in groups])
    return model


def probability(found: Column, model: Model) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * evidence(found, model))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxic_found`` (``SEGMENTS``) and ``toxic_score`` (0 to 1).

    Null and empty texts have no segments and the score of no evidence; a
    column of either name is replaced; rows are otherwise kept as they are.
    """
    kept = [c for c in docs.columns if c not in ("toxic_found", "toxic_score")]
    found = docs.select(*kept, segment_column(F.col("text"), model.lexicon).alias("toxic_found"))
    return found.withColumn("toxic_score", probability(F.col("toxic_found"), model))


def in_fold(doc_id: Column) -> Column:
    """The rows that are held out: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
