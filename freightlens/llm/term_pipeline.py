"""Ranked lexical search by pipelined term partitioning.

The documents become inverted lists in shards of about 8 MB of text, built
where the text is read.  Terms are owned by successive stages, the rarest
first.  An item's bundle for a shard carries sparse accumulators (document,
integer score) from stage to stage; at each stage it meets, by a cogroup on
the shard, the lists of the terms which that stage owns, adds their integer
contributions and travels on.  After the last stage the best are selected.

Accumulators that cannot reach the result are left behind, without any loss:
with the bounds of all contributions that later stages may add, a document
stays only if it can still reach the ``k``-th best score so far (of the shard,
and of all shards before the stage).  A document left behind and met again
later has less than its full score, which is below that ``k``-th best already.

Bounds: a term held by every document is a list per shard, so no task has it
whole; a cogroup's two sides are one shard's lists of a stage and the bundles
of the items there.  A filter of item terms, a fixed 1 MB of bits, goes to the
tasks that read documents; what it lets through wrongly falls in the join with
the terms.  Index, terms and the bundles of each stage are written to the
shared folder, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from freightlens.llm.common import Scratch, Words, ascii_lower, from_parts, lists, slices, utf8_parts

#: Smallest weights of a term for the stages but the last; a rarer term weighs more.
STAGES = (5500, 3500, 2000)
#: Bits of the filter of item terms, in 256 bitmaps of 4 KB.
BITS = 1 << 23
#: Text bytes of a shard.
SHARD_BYTES = 8 << 20
#: Characters that belong to no term.
BREAKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

INDEX = "shard long, term string, size long, total long, docs array<int>, tfs array<int>, ns array<int>, ids array<long>"
BUNDLE = "shard long, item long, terms array<struct<stage:int,id:long,w:long,bound:long>>, docs array<int>, scores array<long>, ids array<long>"


# ---------------------------------------------------------------- terms

def _terms(texts: pa.Array) -> Words:
    """The terms of texts: runs without ``BREAKS``, A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    kept = np.zeros(256, dtype=bool)
    kept[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    table[65:91] += 32
    table[~kept] = 32
    offsets, data = utf8_parts(pc.fill_null(texts.cast(pa.string()), ""))
    return Words(from_parts(offsets, table[data]), lower=False)


def _bits(words: np.ndarray) -> np.ndarray:
    return (pd.util.hash_array(words, categorize=False) % np.uint64(BITS)).astype(np.int64)


@F.arrow_udf(LongType())
def _bit(terms: pa.Array) -> pa.Array:
    return pa.array(_bits(terms.to_numpy(zero_copy_only=False)))


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term``: the different terms of each row of items."""
    found = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"([^{BREAKS}]+)"), 1)
    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(found).alias("terms"))
    return rows.select("item", "item_id", F.explode("terms").alias("term"))


def term_filter(terms: DataFrame) -> np.ndarray:
    """``BITS`` booleans, true where a term of ``terms`` hashes to (at most 1 MB to the driver)."""
    bit = _bit(F.col("term")) + 1
    maps = (terms.select("term").distinct().select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = np.zeros(BITS, dtype=bool)
    for r in maps:
        out[(r.bucket - 1) << 15:r.bucket << 15] = np.unpackbits(np.frombuffer(r.bits, dtype=np.uint8), bitorder="little").astype(bool)
    return out


# ---------------------------------------------------------------- index

def build_index(docs: DataFrame, wanted: np.ndarray, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per shard one row without a term (ids of its documents, how many have
    terms, all their terms) and one row for each wanted term (documents by
    their number in the shard, occurrences, and the documents' term counts)."""
    packed = np.packbits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.unpackbits(packed).astype(bool)
        part, number = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", shard_bytes):
            words = _terms(b.column("text"))
            n, rows = words.counts, words.rows()
            found = keep[_bits(words.distinct.to_numpy(zero_copy_only=False))] if len(words.distinct) else np.zeros(0, dtype=bool)
            own = found[words.codes]
            # (term, document) pairs in order, and how often each occurs
            pairs, tfs = np.unique(words.codes[own].astype(np.int64) * len(n) + rows[own], return_counts=True)
            codes, docs_ = pairs // len(n), pairs % len(n)
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            ends = np.append(first, len(codes))
            shard, number = (part << 32) + number, number + 1
            none = np.zeros(len(first) + 2, dtype=np.int64)
            lead = lambda own, ends: np.concatenate(([0, own], own + ends[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(first) + 1, shard), pa.int64()),
                pa.concat_arrays([pa.nulls(1, pa.string()), words.distinct.take(pa.array(codes[first])).cast(pa.string())]),
                pa.array(np.concatenate(([np.count_nonzero(n)], np.diff(ends))), pa.int64()),
                pa.array(np.concatenate(([n.sum()], none[2:])), pa.int64()),
                lists(docs_, lead(0, ends), pa.int32()), lists(tfs, lead(0, ends), pa.int32()), lists(n[docs_], lead(0, ends), pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.append([0], np.full(len(first) + 1, len(n))), pa.int32()), b.column("doc_id").cast(pa.int64()))],
                names=["shard", "term", "size", "total", "docs", "tfs", "ns", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX)


def impacts(tfs: np.ndarray, ns: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A term's contribution for each weight unit: 64-bit integers, divisions round down."""
    tfs, ns = tfs.astype(np.int64), ns.astype(np.int64)
    m = 100 - 50 + (50 * ns * documents) // terms
    return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)


def _highest(documents: int, terms: int, tfs: Column, ns: Column) -> Column:
    """The greatest impact in each list."""

    @F.arrow_udf("long")
    def highest(t: pa.Array, n: pa.Array) -> pa.Array:
        each = impacts(t.flatten().to_numpy(), n.flatten().to_numpy(), documents, terms)
        ends = t.offsets.to_numpy() - t.offsets[0].as_py()
        return pa.array(np.maximum.reduceat(each, ends[:-1]) if len(each) else np.zeros(0), pa.int64())

    return highest(tfs, ns)


def weigh(index: DataFrame, wanted: DataFrame, documents: int, terms: int, stages: tuple[int, ...] = STAGES) -> DataFrame:
    """``term, id, w, bound, stage``: weight, greatest contribution and owner of each wanted term that a document holds."""
    lists_ = index.where("term IS NOT NULL").select("term", "size", _highest(documents, terms, F.col("tfs"), F.col("ns")).alias("top"))
    known = lists_.groupBy("term").agg(F.sum("size").alias("df"), F.max("top").alias("top")).join(wanted.select("term").distinct(), "term")
    w = F.floor(1000 * F.log(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1)))
    stage = F.lit(0)
    for s in stages:
        stage = stage + (F.col("w") < s).cast("int")
    return (known.withColumn("w", w).select("term", F.monotonically_increasing_id().alias("id"), "w", (F.col("w") * F.col("top")).alias("bound"), stage.alias("stage")))


# ---------------------------------------------------------------- stages

def _visit(stage: int, documents: int, terms: int, k: int, last: bool):
    """What a stage does with the bundles at one shard."""

    def run(postings: pa.Table, bundles: pa.Table) -> pa.Table:
        owned, ids, size = {}, None, 0
        for r in range(postings.num_rows):
            row = {c: postings.column(c)[r] for c in ("id", "w", "docs", "tfs", "ns", "ids")}
            if not row["id"].is_valid:
                ids = row["ids"].values
                size = max(size, len(ids))
                continue
            at = row["docs"].values.to_numpy()
            owned[row["id"].as_py()] = at, row["w"].as_py() * impacts(row["tfs"].values.to_numpy(), row["ns"].values.to_numpy(), documents, terms)
            size = max(size, int(at[-1]) + 1)
        for docs in bundles.column("docs"):
            if len(docs):
                size = max(size, int(docs.values.to_numpy()[-1]) + 1)
        order = None
        if ids is not None:  # place of each document by ascending id, null ids last
            order = np.empty(len(ids), dtype=np.int64)
            order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        out_docs, out_scores, out_ids, kept = [], [], [], []
        for r in range(bundles.num_rows):
            own = bundles.column("terms")[r].as_py()
            score = np.zeros(size, dtype=np.int64)
            score[bundles.column("docs")[r].values.to_numpy()] = bundles.column("scores")[r].values.to_numpy()
            for t in own:
                if t["stage"] == stage and t["id"] in owned:
                    at, each = owned[t["id"]]
                    score[at] += each
            rest = sum(t["bound"] for t in own if t["stage"] > stage)
            floor = bundles.column("floor")[r].as_py() or 1
            docs = np.flatnonzero(score)
            if len(docs) > k:
                floor = max(floor, int(np.partition(score[docs], -k)[-k]))
            docs = docs[score[docs] + rest >= floor]
            if last and len(docs) > k:  # ties beyond the k-th go by id
                docs = np.sort(docs[np.lexsort((order[docs], -score[docs]))[:k]])
            if len(docs) or rest:
                kept.append(r)
                out_docs.append(docs)
                out_scores.append(score[docs])
                out_ids.append(ids.take(pa.array(docs)) if last else pa.array([], pa.int64()))
        ends = np.concatenate(([0], np.cumsum([len(d) for d in out_docs]))).astype(np.int64)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        chosen = bundles.select(["shard", "item", "terms"]).take(pa.array(kept, pa.int64()))
        id_ends = pa.array(ends if last else np.zeros(len(ends)), pa.int32())
        columns = [lists(join(out_docs), ends, pa.int32()), lists(join(out_scores), ends, pa.int64()),
                   pa.ListArray.from_arrays(id_ends, pa.concat_arrays(out_ids) if out_ids else pa.array([], pa.int64()))]
        for name, c in zip(("docs", "scores", "ids"), columns, strict=True):
            chosen = chosen.append_column(name, c)
        return chosen

    return run


def floors(bundles: DataFrame, k: int) -> DataFrame:
    """``item, floor``: the k-th best score so far of the items that have as many."""
    best = bundles.select("item", F.explode(F.slice(F.sort_array("scores", asc=False), 1, k)).alias("score"))
    kth = best.withColumn("_n", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(f"_n <= {k}")
    return kth.where(f"_n = {k}").select("item", F.col("score").alias("floor"))


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = 50, stages: tuple[int, ...] = STAGES,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items(item_id, text)``
    the ``k`` rows of ``docs(doc_id, text)`` with the highest scores above 0.

    Equal scores go by ascending doc_id, null ids last.  Every row is a
    document and every row an item of its own: repeated ids and equal texts
    keep their rows, and equal items get equal results.  Null and empty texts
    have no terms: such documents are not counted, such items have no result.
    Other columns take no part; without documents or items there are no rows.
    """
    wanted = scratch.write(item_terms(items), "items")
    index = scratch.write(build_index(docs, term_filter(wanted), shard_bytes), "index")
    total = index.where("term IS NULL").agg(F.sum("size").alias("n"), F.sum("total").alias("l")).first()
    documents, all_terms = total.n or 0, total.l or 0
    terms = scratch.write(weigh(index, wanted, documents, all_terms, stages), "terms")
    listed = (wanted.select("item", "item_id", "term").join(terms, "term").groupBy("item")
              .agg(F.collect_list(F.struct("stage", "id", "w", "bound")).alias("terms"), F.first("item_id").alias("item_id")))
    listed = scratch.write(listed, "listed")
    placed = index.select("shard", "term").join(terms.select("term"), "term").join(wanted.select("item", "term"), "term").select("shard", "item").distinct()
    empty = [F.array().cast(t).alias(c) for c, t in (("docs", "array<int>"), ("scores", "array<bigint>"), ("ids", "array<bigint>"))]
    written = scratch.write(placed.join(listed.drop("item_id"), "item").select("shard", "item", "terms", *empty), "stage-0")
    bundles = written.withColumn("floor", F.lit(None).cast("long"))
    for s in range(len(stages) + 1):
        last = s == len(stages)
        postings = index.join(terms.where(F.col("stage") == s), "term").select("shard", "id", "w", "docs", "tfs", "ns", F.lit(None).cast("array<bigint>").alias("ids"))
        if last:
            nothing = [F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("w", "long"))]
            postings = postings.unionByName(index.where("term IS NULL").select("shard", *nothing, "docs", "tfs", "ns", "ids"))
        met = postings.groupBy("shard").cogroup(bundles.groupBy("shard")).applyInArrow(_visit(s, documents, all_terms, k, last), BUNDLE)
        written = scratch.write(met, f"stage-{s + 1}")
        scratch.drop(f"stage-{s}")
        bundles = written.join(floors(written, k), "item", "left")
    found = written.select("item", F.inline(F.arrays_zip("scores", "ids"))).select("item", F.col("scores").alias("score"), F.col("ids").alias("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))).cast("int"))
    return ranked.where(F.col("rank") <= k).join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
