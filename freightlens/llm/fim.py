"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors ``(buffer, start, length)`` over two
buffers that never change: its text and the sentinels, both as UTF-8 bytes.

* ``cut``: two unit boundaries split the one descriptor of a text in three
  (prefix, middle, suffix);
* an arrangement permutes the three and puts a sentinel's descriptor before
  each; no text is copied for that;
* hashes stream over the descriptors;
* ``restore`` finds the sentinels of an output, which gives the three
  descriptors over the output's bytes, and applies the inverse permutation.

Units are runs of A-Z, a-z and single other characters.  All positions of a
slice of texts are found at once on its bytes, and a slice holds about 1 MB of
text (a longer text comes alone), so memory is bounded by the longest text.
Rows are independent: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from freightlens.llm.common import slices, utf8_parts

#: Sentinels before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: The pieces of each form in the order of its output.
ARRANGEMENTS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: The sentinel of a piece.
MARK_OF = {PREFIX: 0, SUFFIX: 1, MIDDLE: 2}
#: Text bytes worked on at once.
SLICE_BYTES = 1 << 20

FIM = ("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,"
       "pieces:array<struct<buffer:string,start:bigint,length:bigint>>,output:string,output_sha256:string>")


def check_marks(marks: tuple[str, str, str]) -> None:
    """A sentinel's first character is found nowhere else in the sentinels, so
    that none can arise where two pieces meet."""
    joined = "".join(marks)
    if len(set(marks)) != 3 or any(not m or m[0] in "".join(x[1:] for x in marks) for m in marks) or not joined.strip():
        raise ValueError("three different sentinels, whose first characters occur only there, are needed")


def draws(key: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first groups of the sha256 of ``seed:key``; a null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


class Units:
    """The units of many texts, as byte positions in their common buffer."""

    def __init__(self, texts: pa.StringArray):
        self.at, self.data = utf8_parts(texts)
        self.at = self.at.astype(np.int64)
        low = self.data | 32
        letter = (low >= 97) & (low <= 122)
        first = (self.data & 0xC0) != 0x80  # first byte of a character
        joined = np.zeros(len(letter), dtype=bool)
        joined[1:] = letter[1:] & letter[:-1]
        joined[self.at[:-1][np.diff(self.at) > 0]] = False
        self.starts = np.flatnonzero(first & ~joined)
        self.base = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.base)
        self.chars = np.concatenate(([0], np.cumsum(first, dtype=np.int32)))

    def place(self, units: np.ndarray) -> np.ndarray:
        """Byte where the unit of this number starts in each text; the end of the text for its unit count."""
        if not len(self.starts):
            return self.at[:-1]
        inside = units < self.counts
        return np.where(inside, self.starts[np.minimum(self.base[:-1] + units, len(self.starts) - 1)], self.at[1:])


def arrange(pieces: list[tuple[int, int]], form: str, marks: list[bytes]) -> list[tuple[str, int, int]]:
    """Descriptors of an output: each piece (start, length) after its sentinel."""
    begins = np.concatenate(([0], np.cumsum([len(m) for m in marks])))
    out = []
    for p in ARRANGEMENTS[form]:
        m = MARK_OF[p]
        out += [("marks", int(begins[m]), len(marks[m])), ("text", *pieces[p])]
    return out


def stream(pieces: list[tuple[str, int, int]], buffers: dict[str, memoryview]) -> Iterator[memoryview]:
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def sha256(parts: Iterator[memoryview]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def restored_pieces(output: bytes, form: str, marks: list[bytes]) -> list[tuple[str, int, int]]:
    """Descriptors over an output's bytes whose texts joined are the original."""
    if form not in ARRANGEMENTS:
        return [("text", 0, len(output))]
    order, found, at = ARRANGEMENTS[form], [], 0
    for p in order:
        m = marks[MARK_OF[p]]
        at = output.index(m, at)
        found.append((at, at + len(m)))
        at += len(m)
    ends = [*[a for a, _ in found[1:]], len(output)]
    spans = [("text", b, e - b) for (_, b), e in zip(found, ends, strict=True)]
    return [spans[i] for i in np.argsort(order)]


def _with_column(b: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    keep = [i for i, c in enumerate(b.schema.names) if c != name]
    return pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], column], names=[*[b.schema.names[i] for i in keep], name])


def transform(docs: DataFrame, seed: str = "1", marks: tuple[str, str, str] = MARKS, plain_percent: int = 10, spm_percent: int = 20,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``fim``: unit count, form, code points of prefix and middle
    (null if plain), descriptors of the output, the output and its sha256.

    Cuts and form follow from hashes of the key alone, so repeated keys are
    cut by the same numbers and a null key is an empty one.  A null text is
    empty; an empty text, or one with a sentinel in it, stays plain.  Of the
    others ``plain_percent`` stay plain, and ``spm_percent`` of the rest have
    the suffix first.  A column ``fim`` is replaced, others stay; an empty
    table stays empty.
    """
    check_marks(marks)
    docs = docs.drop("fim")
    struct = StructType.fromDDL(f"fim {FIM}")
    schema = StructType([*docs.schema.fields, struct["fim"]])
    raw = [m.encode() for m in marks]
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                      ("pieces", pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))),
                      ("output", pa.string()), ("output_sha256", pa.string())])
    marks_buffer = memoryview(b"".join(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, SLICE_BYTES):
            texts = pc.fill_null(b.column(text).cast(pa.string()), "")
            h = np.array(b.column("fim").flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(-1, 4)
            units = Units(texts)
            n = units.counts
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            start, end = units.at[:-1], units.at[1:]
            cut, back = units.place(np.minimum(one, two)), units.place(np.maximum(one, two))
            marked = np.zeros(len(texts), dtype=bool)
            for m in marks:
                marked |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
            plain = (n == 0) | marked | (h[:, 2] % 100 >= 100 - plain_percent)
            forms = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm_percent, "spm", "psm"))
            rows, all_pieces, ends = [], [], [0]
            whole = memoryview(units.data)
            for i, form in enumerate(forms.tolist()):
                own = whole[int(start[i]):int(end[i])]
                a, z, size = int(cut[i] - start[i]), int(back[i] - start[i]), len(own)
                pieces = [("text", 0, size)] if form == "plain" else arrange([(0, a), (a, z - a), (z, size - z)], form, raw)
                buffers = {"text": own, "marks": marks_buffer}
                prefix, middle = (None, None) if form == "plain" else (units.chars[cut[i]] - units.chars[start[i]], units.chars[back[i]] - units.chars[cut[i]])
                all_pieces += pieces
                ends.append(len(all_pieces))
                rows.append((int(n[i]), form, prefix, middle, b"".join(stream(pieces, buffers)).decode(), sha256(stream(pieces, buffers))))
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            each = [pa.array([p[k] for p in all_pieces], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            columns.insert(4, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(each, names=["buffer", "start", "length"])))
            yield _with_column(b, "fim", pa.StructArray.from_arrays(columns, fields=list(kind)))

    return docs.withColumn("fim", F.array(*draws(F.col(key), seed))).mapInArrow(run, schema)


def restore(df: DataFrame, output: Column, form: Column, marks: tuple[str, str, str] = MARKS, into: str = "restored") -> DataFrame:
    """``df`` with the original text rebuilt from an output and its form alone.

    A null output is an empty one, a null or unknown form is plain.  A psm or
    spm output without its sentinels is an error.  A column named ``into`` is
    replaced, others stay.
    """
    check_marks(marks)
    raw = [m.encode() for m in marks]

    @F.arrow_udf("string")
    def rebuilt(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        done = []
        for b in slices([pa.record_batch([outputs, forms], names=["output", "form"])], "output", SLICE_BYTES):
            texts = pc.fill_null(b.column(0).cast(pa.string()), "")
            at, data = utf8_parts(texts)
            whole = data.tobytes()
            for i, f in enumerate(b.column(1).to_pylist()):
                own = whole[at[i]:at[i + 1]]
                done.append(b"".join(stream(restored_pieces(own, f, raw), {"text": memoryview(own)})).decode())
        return pa.array(done, pa.string())

    return df.withColumn(into, rebuilt(output, form))
