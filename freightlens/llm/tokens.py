"""Token ids of texts, and a binary format for them.

Format: one Arrow IPC file per shard.  Its record batches hold two fixed-size
list columns of ``length`` items, ``input_ids`` (the narrowest unsigned type
that fits the vocabulary) and ``mask`` (true for ids, false for padding), and
all batches but the last have ``BATCH`` rows.  Buffers are not compressed: a
reader maps the file and sequence ``i`` is row ``i % BATCH`` of batch
``i // BATCH``, without copying or decoding.  A shard's documents follow one
another across sequences; only its last sequence is padded.  Beside it an
index file has ``doc_id, start, n_tokens`` of each document in order.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import Scratch, Words, slices

BATCH = 512
# Bytes of text whose distinct words are looked up together.
SLICE_BYTES = 32 << 20
JOINED = 1000
# The table of known words is emptied beyond this size.
KNOWN_WORDS = 500_000

# Words that may be encoded next to each other in one call: printable ASCII and
# Latin-1 letters, which no normaliser merges or reorders; and the parts into
# which the word tokenizer's pattern cuts them (a fixed value of that file).
_SIMPLE = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\s\pL\pN]+"


class Encoder:
    """Ids of texts by a file of the tokenizers library, without special tokens,
    then the end id.

    ``by_word``: encode each distinct run without white space once, keep it in a
    bounded table, and gather the ids, for tokenizers that drop white space and never join
    across it.  Where the vocabulary marks word ends (``</w>``), simple words
    are encoded many to a call and cut apart at these marks.
    """

    def __init__(self, path: str, end: int, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tok, self.by_word, self.end = Tokenizer.from_file(path), by_word, np.array([end], dtype=np.uint32)
        self.size = max(self.tok.get_vocab_size(), end + 1)
        self.closes = np.zeros(self.size, dtype=bool)
        for word, i in self.tok.get_vocab().items():
            self.closes[i] = word.endswith("</w>")
        self._forget()

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and how many each text has."""
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], dtype=np.uint32), np.array([len(x) for x in found], dtype=np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_each`` for words without white space."""
        if not self.closes.any():
            return self._each(words.to_pylist())
        simple = pc.and_not(pc.match_substring_regex(words, _SIMPLE), pc.match_substring(words, "<|")).to_numpy(zero_copy_only=False)
        plain = words.filter(pa.array(simple))
        parts = pc.count_substring_regex(plain, _PARTS).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = plain.to_pylist()
        ids, _ = self._each([" ".join(texts[i:i + JOINED]) for i in range(0, len(texts), JOINED)])
        closing = np.flatnonzero(self.closes[ids])
        if len(closing) != parts.sum() or len(plain) == 0:
            return self._each(words.to_pylist())
        last = closing[np.cumsum(parts) - 1]
        counts = np.diff(np.concatenate(([-1], last)))
        if simple.all():
            return ids, counts
        rest, rest_counts = self._each(words.filter(pa.array(~simple)).to_pylist())
        sizes = np.zeros(len(words), dtype=np.int64)
        sizes[simple], sizes[~simple] = counts, rest_counts
        out = np.empty(len(ids) + len(rest), dtype=np.uint32)
        own = np.repeat(simple, sizes)
        out[own], out[~own] = ids, rest
        return out, sizes

    def _lookup(self, distinct: pa.Array) -> np.ndarray:
        """Places of words in the table of known words, which gains the new ones."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        at = pc.index_in(distinct, self.known)
        new = distinct.filter(at.is_null())
        if len(new):
            ids, sizes = self._words(new)
            self.known = pa.concat_arrays([self.known, new])
            self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
            at = pc.index_in(distinct, self.known)
        return at.to_numpy(zero_copy_only=False).astype(np.int64)

    def _forget(self) -> None:
        self.known, self.flat, self.sizes = pa.array([], pa.string()), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the offset of each text's first; a null text is empty."""
        if self.by_word:
            words = Words(texts, lower=False)
            codes, offsets = self._lookup(words.distinct)[words.codes], words.offsets
            flat, size = self.flat, self.sizes
        else:
            flat, size = self._each([t or "" for t in texts.to_pylist()])
            codes, offsets = np.arange(len(texts)), np.arange(len(texts) + 1)
        flat, size = np.append(flat, self.end), np.append(size, 1)
        first = np.cumsum(size) - size
        # the words of each text and then the end id, as numbers into the lists of ids
        codes = np.insert(codes, offsets[1:], len(size) - 1)
        n = size[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        return flat[np.repeat(first[codes] - ends[:-1], n) + np.arange(ends[-1])], ends[offsets + np.arange(len(offsets))]


@cache
def encoder_for(path: str, end: int, by_word: bool = True) -> Encoder:
    """One encoder, with its table of words, for all tasks of a Python worker."""
    return Encoder(path, end, by_word)


# ---------------------------------------------------------------- files

def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark resolves it: a path without a
    scheme lies on the cluster's default file system, not on a task's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return pafs.LocalFileSystem(), folder


class SequenceWriter:
    """Streams ids into one shard file; holds at most one batch of sequences."""

    def __init__(self, sink, length: int, dtype: np.dtype, end: int):
        self.length, self.dtype = length, dtype
        schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))],
                           metadata={"length": str(length), "end_id": str(end), "batch": str(BATCH)})
        self.file, self.schema = pa.ipc.new_file(sink, schema), schema
        self.buffer, self.filled, self.total = np.zeros(BATCH * length, dtype=dtype), 0, 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.buffer) - self.filled)
            self.buffer[self.filled:self.filled + n] = ids[at:at + n]
            self.filled, at = self.filled + n, at + n
            if self.filled == len(self.buffer):
                self._flush()
        self.total += len(ids)

    def _flush(self) -> None:
        n = -(-self.filled // self.length) * self.length
        self.buffer[self.filled:n] = 0
        columns = (pa.array(self.buffer[:n]), pa.array(np.arange(n) < self.filled))
        self.file.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns], schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.file.close()


class SequenceReader:
    """Random access to the sequences of a shard file, mapped where it is local."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = int(self.file.schema.metadata[b"length"])

    def _batch(self, k: int) -> np.ndarray:
        return self.file.get_batch(k).column(0).flatten().to_numpy()

    def sequence(self, i: int) -> np.ndarray:
        return self._batch(i // BATCH)[i % BATCH * self.length:][:self.length]

    def mask(self, i: int) -> np.ndarray:
        row = self.file.get_batch(i // BATCH).column(1).slice(i % BATCH, 1)
        return row.flatten().to_numpy(zero_copy_only=False)

    def span(self, start: int, count: int) -> np.ndarray:
        """The ids from place ``start`` of the shard on."""
        per, out = BATCH * self.length, []
        while count:
            k, at = divmod(start, per)
            part = self._batch(k)[at:at + count]
            out.append(part)
            start, count = start + len(part), count - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end: int = 1, length: int = 2048, by_word: bool = True) -> DataFrame:
    """Write the ids of ``docs(doc_id, text)`` in ascending ``doc_id`` order, one
    shard per range of ids, under ``folder`` (shared by the cluster).

    Returns ``shard, file, n_docs, n_tokens, n_sequences``: one row per shard,
    not yet computed; computing it writes the files.  A task writes under a
    name of its own and renames at the end, so a task that runs again leaves
    the same file.  Null texts are empty (the end id alone), null ids come
    first, rows that repeat an id are ordered by text and all written; an empty
    table writes no shard.
    """

    folder = qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequences, n_docs = encoder_for(tokenizer, end, by_word), None, 0
        shard, (fs, base) = TaskContext.get().partitionId(), _open(folder)
        name, own = f"{base}/shard-{shard:06d}", uuid.uuid4().hex
        dtype = np.dtype(np.uint16 if encoder.size <= 1 << 16 else np.uint32)
        for b in slices(batches, "text", SLICE_BYTES):
            if sequences is None:
                fs.create_dir(base, recursive=True)
                streams = [fs.open_output_stream(f"{name}.{x}.{own}") for x in ("arrow", "index")]
                sequences = SequenceWriter(streams[0], length, dtype, end)
                schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(streams[1], schema)
            ids, offsets = encoder.encode(b.column("text"))
            index.write_batch(pa.record_batch([b.column("doc_id"), pa.array(sequences.total + offsets[:-1]), pa.array(np.diff(offsets))], schema=schema))
            sequences.add(ids.astype(dtype))
            n_docs += b.num_rows
        if sequences is None:
            return
        sequences.close()
        index.close()
        for x, stream in zip(("arrow", "index"), streams, strict=True):
            stream.close()
            fs.move(f"{name}.{x}.{own}", f"{name}.{x}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "file": [f"shard-{shard:06d}"], "n_docs": [n_docs],
                                          "n_tokens": [sequences.total], "n_sequences": [-(-sequences.total // length)]})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .mapInArrow(write, "shard int, file string, n_docs long, n_tokens long, n_sequences long"))


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of every
    document in the files that ``shards`` lists; ``start`` counts the ids of all
    documents before it.  One task reads one or a few shards, a piece at a time."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = shards.select("file", F.coalesce(before, F.lit(0)).alias("base"))  # one row per file
    folder = qualified(shards.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for b in batches:
            for name, before in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                tokens, index = SequenceReader(fs, f"{base}/{name}.arrow"), pa.ipc.open_file(fs.open_input_file(f"{base}/{name}.index"))
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    start, n = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    ids = [tokens.span(s, c).astype("<u4").tobytes() for s, c in zip(start.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(start + before), docs.column("n_tokens"), pa.array(ids, pa.binary())],
                                                     names=["doc_id", "start", "n_tokens", "ids"])

    return files.repartition(max(1, shards.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, end: int = 1, length: int = 2048) -> DataFrame:
    """Write the files under the shared checkpoint folder and read them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = scratch.path("files")
    shards = scratch.write(write_sequences(docs, folder, tokenizer, end, length), "shards")
    return read_documents(shards, folder)
