"""MinHash near-duplicate detection with min-max hashing.

Every random permutation of the shingle hashes gives two signature values,
the smallest and the largest, so a signature of 2K values costs K hash
evaluations.  Bands are made of minima of distinct permutations, and as many
of maxima; each value agrees with probability equal to the Jaccard similarity.

The work on Spark:

1. One pass over the texts: set size, a 128-bit fingerprint of the set and
   the band hashes.  Texts with equal sets are collapsed to the smallest id
   (``min`` is combined before the shuffle).
2. Candidates come from band buckets without listing a bucket's pairs: every
   member is first compared with the smallest id of its bucket.
3. Buckets that then still hold several components: up to ``SMALL`` members,
   their pairs of different components are compared; above, the members outside
   the bucket's largest component are compared with all members, block by block
   inside tasks, and only links found are returned.
4. Candidates are confirmed on the full sets, links are merged into
   components by distributed rounds.

Given the bands, no link is lost: after step 3 every pair of a bucket has been
compared or is joined already.  A pair at the threshold 0.8 shares no bucket
with probability (1 - 0.8^6)^36 = 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import (U64, Scratch, Words, connected_components, lists, mix, shingle_sets, slices)

ROWS_PER_BAND = 6
BANDS = 36  # half of minima, half of maxima
SMALL = 16  # members of a bucket whose pairs are listed; at most 15 for each member
# Rows of a block comparison, and columns of its incidence matrices at a time.
BLOCK_LEFT, BLOCK_RIGHT, COLUMNS = 256, 512, 1 << 14
SEED = 20240

#: Rows that the members of one hub are dealt to when pairs are confirmed.
SALTS = 1024
#: Text bytes worked on at once.
SLICE_BYTES = 2 << 20

SIGNED = "doc_id long, text_hash long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def permutations(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), \
        r.integers(0, 1 << 32, count, dtype=np.uint32)


def minmax(values: np.ndarray, offsets: np.ndarray, count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima (texts x count) of ``count`` permutations over non-empty sets."""
    mult, add = permutations(count, seed)
    x = (values >> U64(32)).astype(np.uint32)
    lo = np.empty((len(offsets) - 1, count), dtype=np.uint32)
    hi = np.empty_like(lo)
    for k in range(count):
        v = x * mult[k] + add[k]
        lo[:, k] = np.minimum.reduceat(v, offsets[:-1])
        hi[:, k] = np.maximum.reduceat(v, offsets[:-1])
    return lo, hi


def band_hashes(lo: np.ndarray, hi: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash per band (texts x bands): minima first, then maxima."""
    out = []
    for side, m in enumerate((lo, hi)):
        for start in range(0, m.shape[1], rows):
            h = np.full(len(m), (side << 32) + start + 1, dtype=U64)
            for k in range(start, start + rows):
                h = mix(h * U64(0x9E3779B97F4A7C15) + m[:, k].astype(U64))
            out.append(h)
    return np.stack(out, axis=1).view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """``SIGNED`` of every row of ``docs(doc_id, text)``; bands are empty for an empty set."""
    per_side = bands // 2 * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            values, offsets = shingle_sets(Words(b.column("text")), words)
            sizes = np.diff(offsets)
            full = sizes > 0
            fp1, fp2 = np.zeros((2, len(sizes)), dtype=U64)
            kept = np.zeros((0, bands), dtype=np.int64)
            if full.any():
                starts = offsets[:-1][full]
                fp1[full] = np.add.reduceat(values, starts)
                fp2[full] = np.add.reduceat(mix(values + U64(1)), starts)
                kept = band_hashes(*minmax(values, np.append(starts, len(values)), per_side), rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)),
                 lists(kept.ravel(), np.concatenate(([0], np.cumsum(full * bands))), pa.int64())],
                names=["doc_id", "text_hash", "n_shingles", "fp1", "fp2", "bands"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(sign, SIGNED)


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` with 100 * intersection >= percent * union of the full
    sets of ``texts(doc_id, text)``.

    ``a`` may be a hub of very many pairs: its members are dealt to ``SALTS``
    groups, and a group's rows arrive sorted, the hub's text first and once, so
    that a task holds one hub's set at a time.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, dtype=U64)
        for b in slices(batches, "text", SLICE_BYTES):
            values, offsets = shingle_sets(Words(b.column("text")), words)
            is_hub = b.column("b").is_null().to_numpy(zero_copy_only=False)
            good = np.zeros(b.num_rows, dtype=bool)
            for i in range(b.num_rows):
                own = values[offsets[i]:offsets[i + 1]]
                if is_hub[i]:
                    hub = own
                    continue
                lo, hi = sorted((len(hub), len(own)))
                if lo and 100 * lo >= percent * hi:
                    both = np.count_nonzero(hub[np.minimum(np.searchsorted(hub, own), len(hub) - 1)] == own)
                    good[i] = 100 * both >= percent * (len(hub) + len(own) - both)
            hub = hub.copy()  # not a view of the whole slice
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(good)), b.column("b").filter(pa.array(good))],
                                             names=["a", "b"])

    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    a, b = (texts.select(F.col("doc_id").alias(k), "text") for k in "ab")
    hubs = dealt.select("a", "salt").distinct().join(a, "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    members = dealt.join(b, "b").select("a", "salt", "b", "text")
    return (hubs.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
            .mapInArrow(check, "a long, b long"))


def common_counts(va: np.ndarray, oa: np.ndarray, vb: np.ndarray, ob: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, by matrix products over
    a bounded number of shingles at a time."""
    shared = np.intersect1d(va, vb)
    rows = [np.repeat(np.arange(len(o) - 1), np.diff(o)) for o in (oa, ob)]
    out = np.zeros((len(oa) - 1, len(ob) - 1), dtype=np.int64)
    for at in range(0, len(shared), COLUMNS):
        part = shared[at:at + COLUMNS]
        sides = []
        for v, row, n in ((va, rows[0], len(oa) - 1), (vb, rows[1], len(ob) - 1)):
            column = np.minimum(np.searchsorted(part, v), len(part) - 1)
            hit = part[column] == v
            m = np.zeros((n, len(part)), dtype=np.float32)
            m[row[hit], column[hit]] = 1
            sides.append(m)
        out += (sides[0] @ sides[1].T).astype(np.int64)  # counts below 2^24 are exact
    return out


def block_links(rows: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between different components inside large buckets.

    ``rows(bucket, doc_id, component, main, size, strays)``: members outside the
    bucket's ``main`` component meet all members, in tiles of bounded size.  Of
    the links between two components a tile returns one.
    """

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        left = t.column("left").to_numpy(zero_copy_only=False)
        x, y = t.filter(pa.array(left)), t.filter(pa.array(~left))
        a, b = [], []
        if x.num_rows and y.num_rows:
            (va, oa), (vb, ob) = (shingle_sets(Words(s.column("text").combine_chunks()), words) for s in (x, y))
            n = common_counts(va, oa, vb, ob)
            union = np.diff(oa)[:, None] + np.diff(ob)[None, :] - n
            ca, cb = (s.column("component").to_numpy() for s in (x, y))
            i, j = np.nonzero((100 * n >= percent * union) & (ca[:, None] != cb[None, :]))
            _, first = np.unique(np.stack([ca[i], cb[j]]), axis=1, return_index=True)
            a, b = x.column("doc_id").to_numpy()[i[first]], y.column("doc_id").to_numpy()[j[first]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    block = lambda n, size, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.ceil(F.col(n) / size)).cast("int")
    every = lambda n, size: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / size).cast("int") - 1))
    rows = rows.join(docs.select("doc_id", "text"), "doc_id")
    keep = ["bucket", "doc_id", "component", "text"]
    left = rows.where("component <> main").select(*keep, F.lit(True).alias("left"), block("strays", BLOCK_LEFT, 1).alias("i"), every("size", BLOCK_RIGHT).alias("j"))
    right = rows.select(*keep, F.lit(False).alias("left"), every("strays", BLOCK_LEFT).alias("i"), block("size", BLOCK_RIGHT, 2).alias("j"))
    return left.unionByName(right).groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def grouped(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, first`` for every row of
    ``docs(doc_id, text)``; ``near_duplicates`` says what they mean, ``first``
    marks one row of each component, of its smallest id.

    The nodes are rows: rows that share an id but not the text are linked by
    their own texts alone.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.write(signatures(docs, words).withColumn("row", F.monotonically_increasing_id()), "signed")
    # From here on a row's number stands for it, under the name doc_id.
    known = signed.where("doc_id is not null and n_shingles > 0").select(F.col("row").alias("doc_id"), "n_shingles", "fp1", "fp2", "bands")
    # Group results are written before the rows join them: adaptive execution
    # splits a hot key only where both sides of the join come from a shuffle.
    same = scratch.write(known.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "same")
    reps = same.select(F.col("rep").alias("doc_id"))
    buckets = known.join(reps, "doc_id", "left_semi").select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = scratch.write(buckets.join(scratch.write(shared.select("bucket", "low"), "shared"), "bucket"), "members")

    copies = (known.join(same.where("copies > 1"), ["fp1", "fp2", "n_shingles"])
              .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    links = scratch.write(copies.distinct(), "copies")
    # Whole texts are shuffled once, to keep those that share a bucket.
    ids = signed.select(F.col("row").alias("node"), F.col("doc_id").alias("id"), "text_hash")
    wanted = members.select(F.col("doc_id").alias("node")).distinct().join(ids, "node")
    whole = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text").join(wanted, ["id", "text_hash"])
    texts = scratch.write(whole.select(F.col("node").alias("doc_id"), "text"), "texts")

    star = members.where("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = links.union(scratch.write(confirm(star, texts, words, percent), "links-star"))
    label = connected_components(links, scratch, "cc-star")

    # Buckets with several components.
    placed = (members.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .select("bucket", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")))
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (parts.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("size"),
                                         F.max("n").alias("most"), F.count(F.lit(1)).alias("components")).where("components > 1")
             .select("bucket", "main", "size", (F.col("size") - F.col("most")).alias("strays")))
    open_ = scratch.write(placed.join(scratch.write(mixed, "mixed"), "bucket"), "open")
    small, large = open_.where(F.col("size") <= SMALL), open_.where(F.col("size") > SMALL)
    other = small.select("bucket", F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"), F.col("component").alias("c"))
    pairs = (small.join(other, "bucket").where("component <> c and doc_id < b")
             .where(f"100 * least(n_shingles, m) >= {percent} * greatest(n_shingles, m)")
             .select(F.col("doc_id").alias("a"), "b").distinct())
    found = scratch.write(confirm(pairs, texts, words, percent).union(block_links(large, texts, words, percent)), "links-open")
    if not found.isEmpty():
        label = connected_components(links.union(found), scratch, "cc-open")
    linked = label.join(ids.select("node", "id"), "node")
    first = scratch.write(linked.groupBy("component").agg(F.min(F.struct("id", "node")).alias("first")), "first")
    scratch.drop("same", "shared", "members", "mixed", "open", "texts")
    rows = (signed.select("doc_id", "text_hash", "n_shingles", F.col("row").alias("node")).join(label, "node", "left").join(first, "component", "left"))
    return rows.select("doc_id", "text_hash", "n_shingles", F.coalesce("first.id", "doc_id").alias("component_id"),
                       F.coalesce(F.col("first.node") == F.col("node"), F.lit(True)).alias("first"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Words are lower-cased (A-Z only) runs without ASCII white space; the set of
    a text is its distinct ``words``-word shingles (with fewer words the whole
    sequence).  Two texts are linked if 100 * intersection >= percent * union;
    ``component_id`` is the smallest id reachable, ``kept`` says that it is the
    row's own.

    Null or empty texts: size 0, linked with nothing, kept.  A null id: no
    component (null), kept.  Rows that repeat an id are linked each by its own
    text.  Other columns are ignored; an empty table gives an empty result.
    """
    return (grouped(docs, words, percent).select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, one of its
    smallest id.  Rows without an id all stay, and so do texts without words;
    rows that repeat both id and text stay once, rows that repeat an id with
    another text are judged by that text.  All columns are kept as they are."""
    known = grouped(docs, words, percent).where("doc_id is not null")
    gone = known.groupBy("doc_id", "text_hash").agg(F.bool_or("first").alias("stays")).where("not stays")
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    keyed = docs.where("doc_id is not null").withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")})
    return (keyed.join(gone, ["__id", "__hash"], "left_anti").dropDuplicates(["__id", "__hash"])
            .select(*docs.columns).unionByName(docs.where("doc_id is null")))
