import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from freightlens.llm import packing, tokens
from freightlens.llm.common import Scratch
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return tokens.encoder_for(PATH, 1).tok.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("by_word", [True, False])
def test_encoder_equals_the_library(texts, by_word):
    texts = [None, "", "  ", "it's <|endoftext|>x <| |>", "a\x0bb\x85c d", "İı é ẛ̣", "12,5 can't've"] + [t[1] for t in texts]
    encoder = tokens.Encoder(PATH, 1, by_word)
    for _ in range(2):  # the second time from the table of known words
        ids, offsets = encoder.encode(pa.array(texts))
        assert [ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])] == [ids_of(t) for t in texts]


def test_round_trip_of_edge_rows(edge):
    out = tokens.round_trip(edge, PATH, length=64).collect()
    want, start = [], 0
    for i, t, *_ in sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of(t)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in out), key=lambda x: x[1]) == want


def test_sequences_are_equal_and_padded_only_at_the_end(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    scratch = Scratch(spark, "test")
    shards = scratch.write(tokens.write_sequences(docs, scratch.path("files"), PATH, length=100), "shards").collect()
    all_ids = []
    for s in sorted(shards, key=lambda s: s.shard):
        fs, base = tokens._open(scratch.path("files"))
        reader = tokens.SequenceReader(fs, f"{base}/{s.file}.arrow")
        rows = [reader.sequence(i) for i in range(s.n_sequences)]
        masks = [reader.mask(i) for i in range(s.n_sequences)]
        assert all(len(r) == 100 for r in rows) and all(m.all() for m in masks[:-1])
        assert sum(int(m.sum()) for m in masks) == s.n_tokens
        all_ids += np.concatenate(rows)[:s.n_tokens].tolist()
    assert all_ids == [i for t in texts for i in ids_of(t[1])]


def test_empty_table(nothing):
    assert tokens.round_trip(nothing, PATH).count() == 0
    assert packing.pack(nothing, PATH).count() == 0


def covered(rows, texts):
    """Every id of every row in one piece, offsets gapless."""
    pieces = sorted((repr(r.doc_id), r.doc_tokens, r.start, r.length, zlib.crc32(r.ids)) for r in rows)
    want = sorted((repr(t[0]), len(ids_of(t[1]))) for t in texts)
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) <= own[0].context and len({(r.context, r.step_group) for r in own}) == 1
    return pieces, by_sequence


@pytest.mark.parametrize("chunk", [3000, 4_000_000])
def test_packing_covers_every_id_once(spark, texts, chunk):
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").repartition(2)
    rows = packing.pack(docs, PATH, chunk_tokens=chunk).collect()
    pieces, by_sequence = covered(rows, texts)
    ids = {repr(t[0]): ids_of(t[1]) for t in texts}
    at = dict.fromkeys(ids, 0)
    for doc, total, start, length, c in pieces:
        assert start == at[doc] and total == len(ids[doc]) and c == crc(ids[doc][start:start + length])
        at[doc] += length
    assert all(at[d] == len(x) for d, x in ids.items())
    sizes = [sum(r.length for r in s) for s in by_sequence.values()]
    assert sum(n not in (2048, 1024, 512, 256) for n in sizes) <= 2  # one padded sequence per task


def test_packing_edge_rows(edge):
    covered(packing.pack(edge, PATH).collect(), EDGE)


def test_step_groups_have_one_context_and_little_difference():
    windows, left = packing.pack_lengths([300 + 37 * i % 1900 for i in range(500)])
    groups = packing.step_groups(windows, 8192)
    tokens_of, contexts = {}, {}
    for (context, pieces), g in zip(windows, groups):
        assert sum(n for *_, n in pieces) == context
        tokens_of[g] = tokens_of.get(g, 0) + context
        contexts.setdefault(g, set()).add(context)
    assert all(len(c) == 1 for c in contexts.values()) and max(tokens_of.values()) <= 8192
    assert sum(n for *_, n in left) < 2048


def test_a_path_without_a_scheme_lies_on_the_default_file_system(spark):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert tokens.qualified(spark, "/shared/x") == "file:/shared/x"
    conf.set("fs.defaultFS", "hdfs://127.0.0.1:9")  # never connected to
    try:
        assert tokens.qualified(spark, "/shared/x") == "hdfs://127.0.0.1:9/shared/x"
        assert tokens.qualified(spark, "file:/own/x") == "file:/own/x"
    finally:
        conf.set("fs.defaultFS", before)
