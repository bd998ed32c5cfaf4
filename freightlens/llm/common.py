"""Helpers shared by the corpus operators: word arrays, hashes, written tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.plans.materialize import app_folder, remove_folder

U64 = np.uint64
RELEASE_BYTES = 32 << 20
# The finaliser constants of MurmurHash3 (public domain) and an odd multiplier.
MIX_A, MIX_B, STEP = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53), U64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- tables

def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` to cut lineage.

    The files outlive lost executors and go when the application ends.  ``write`` returns the table read back;
    ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{app_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for n in names:
            remove_folder(self.spark, self.path(n))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- word arrays

def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling."""
    x = x ^ (x >> U64(33))
    x = x * MIX_A
    x = x ^ (x >> U64(33))
    x = x * MIX_B
    return x ^ (x >> U64(33))


def utf8_parts(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of just these texts (a slice shares the
    buffer of its whole batch)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(1, dtype=np.int32)
    return at - at[0], np.frombuffer(data or b"", dtype=np.uint8)[at[0]:at[-1]]


def from_parts(offsets: np.ndarray, data: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def lower_ascii(texts: pa.StringArray) -> pa.StringArray:
    """A-Z to a-z on the bytes of an Arrow string array without nulls (UTF-8 stays valid)."""
    offsets, data = utf8_parts(texts)
    return from_parts(offsets, data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32))


class Words:
    """Words of many texts: ``codes`` of all words in order, ``offsets`` of each
    text's first word, and the distinct words as an Arrow array.

    Words are the runs of characters other than space and U+0009-U+000D; a null
    text has none.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if lower:
            texts = lower_ascii(texts)
        lists = pc.ascii_split_whitespace(texts)
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        ends = ends - ends[0]
        codes = flat.indices.to_numpy(zero_copy_only=False)
        self.distinct = flat.dictionary
        empty = pc.index(self.distinct, "").as_py()
        if empty >= 0:  # white space at the ends of a text leaves empty strings
            full = codes != empty
            ends = np.concatenate(([0], np.cumsum(full)))[ends]
            codes = codes[full]
        self.codes, self.offsets = codes, ends
        self.counts = np.diff(ends)

    def __len__(self) -> int:
        return len(self.counts)

    def rows(self) -> np.ndarray:
        """The text's number for each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word in order."""
        h = pd.util.hash_array(self.distinct.to_numpy(zero_copy_only=False), categorize=False)
        return h[self.codes]


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text as sorted 64-bit hashes:
    all values and the offsets per text.  A text with fewer words (at least
    one) has its whole sequence as one shingle; without words the set is empty.
    """
    h, counts, starts = words.hashes(), words.counts, words.offsets[:-1]
    per_text = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(per_text)))
    first = np.repeat(starts - offsets[:-1], per_text) + np.arange(offsets[-1])  # each shingle's first word
    width = np.repeat(np.minimum(counts, n), per_text)
    x = np.zeros(len(first), dtype=U64)
    for j in range(n):
        inside = width > j
        if inside.all():
            x = mix(x * STEP + h[first + j])
        else:
            x[inside] = mix(x[inside] * STEP + h[first[inside] + j])
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        x[a:b].sort()
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = x[1:] != x[:-1]
    keep[offsets[:-1][per_text > 0]] = True
    return x[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def release() -> None:
    """Give freed memory back to the system: Python workers live on between
    tasks, and what they keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; elsewhere nothing to do
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text (a longer text
    comes alone), so that memory per step is bounded; freed memory is given
    back once ``RELEASE_BYTES`` of text have passed, and at the end."""
    passed = 0
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(total // max_bytes)) + 1, [b.num_rows]))
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield b.slice(i, j - i)
        passed += int(total[-1])
        if passed > RELEASE_BYTES:
            passed = 0
            release()
    release()


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


# ---------------------------------------------------------------- components

def connected_components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges(a, b)``.

    Rounds of minimum propagation and pointer jumping, each written to the
    shared folder: labels reach the minimum in a number of rounds logarithmic
    in the path lengths.  Minima are combined before the shuffle, and joins on
    a hub's key are split by adaptive execution.
    """
    both = scratch.write(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                         .union(edges.select("b", "a")).distinct(), f"{tag}-both")
    label = scratch.write(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), f"{tag}-0")
    turn = 0
    while True:
        near = (both.join(label.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        lowered = label.join(near, "node").select("node", F.col("component").alias("old"),
                                                  F.least("component", "near").alias("component"))
        up = label.select(F.col("node").alias("component"), F.col("component").alias("top"))
        new = scratch.write(lowered.join(up, "component").select(
            "node", F.least("component", "top").alias("component"), "old"), f"{tag}-{turn + 1}")
        moved = not new.where("component <> old").isEmpty()
        scratch.drop(f"{tag}-{turn}")
        label, turn = new.select("node", "component"), turn + 1
        if not moved:
            scratch.drop(f"{tag}-both")
            return label
