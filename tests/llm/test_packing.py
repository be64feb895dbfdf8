"""Operators 2 and 8 against the tokenizer and a plain check of every rule."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import bestfit_packing, packed_ids
from tessera.llm.binpack import best_fit_decreasing, lower_bound
from tessera.llm.common import materialise
from tessera.llm.tokens import default_vocabulary, encoder, piece_bounds

TEXTS = ["", None, "one two", "a  b", "a   b", "tab\t x\n\n y \n z", " lead and trail ", "é ü  ñ 你好 😀",
         "it's we'll 12 345,6", "word " * 3000, "x" * 5000, "a  b \x1c c", "<|endoftext|> in text",
         "end\n", "\n start", "w " * 1023, "w " * 1024]


def _reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [2]


def test_encoder_equals_the_tokenizer(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    ref, texts = _reference(), TEXTS + rows
    assert [i.tolist() for i in encoder(default_vocabulary()).encode(texts)] == [ref(t) for t in texts]


def test_piece_bounds():
    assert piece_bounds(1) == [(0, 1)]
    assert piece_bounds(1024) == [(0, 1024)]
    assert piece_bounds(2050) == [(0, 2), (2, 1024), (1026, 1024)]


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_and_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 33, 300)
    bins, offsets, n = best_fit_decreasing(lengths, 32)
    used = np.bincount(bins, weights=lengths)
    assert used.max() <= 32 and len(used) == n
    # The slow statement of the same rule.
    rooms = []
    for v in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= v]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= v
        else:
            rooms.append(32 - v)
    assert n == len(rooms)
    assert -(-lengths.sum() // 32) <= lower_bound(lengths, 32) <= n


def test_bound_sees_what_the_sum_does_not():
    assert lower_bound(np.array([17] * 10), 32) == 10
    assert lower_bound(np.array([11] * 9), 32) == 5
    assert lower_bound(np.array([], int), 32) == 0


def _check(rows, docs, most=1024):
    ref, seqs, pieces = _reference(), defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for places in seqs.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most
    for doc_id, text in docs:
        ids = np.array(ref(text), "<u4")
        want = [(k, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                for k, (s, n) in enumerate(piece_bounds(len(ids), most))]
        assert sorted(set(pieces[doc_id])) == want
    return len(seqs)


def _docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(2, "one two", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, length string")


def test_packs_odd_texts(spark):
    out = bestfit_packing.packed_documents(_docs(spark)).collect()
    _check(out, enumerate(TEXTS))
    assert len([r for r in out if r.doc_id == 2]) == 2  # a repeated row is packed twice


def test_query_on_whole_table_is_certified(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = bestfit_packing.packed_documents(docs).collect()
    n = _check(out, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    bound = lower_bound(np.array([r.length for r in out]), 1024)
    assert n <= bound * 1.02 + 1


def test_groups_with_a_gap_exchange(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(200, 700, 4000))]
    pieces = materialise(spark.createDataFrame(rows, "doc_id long, length long"), "test")
    few = bestfit_packing.pack(pieces, group_rows=100, rounds=4).collect()
    alone = bestfit_packing.pack(pieces, group_rows=100, rounds=1).collect()
    assert sorted((r.doc_id, r.length) for r in few) == rows
    assert len({r.sequence_id for r in few}) <= len({r.sequence_id for r in alone})


def test_matrices_round_trip(spark, tmp_path):
    docs = _docs(spark)
    packed_ids.write_packed(docs, str(tmp_path / "m"), window_ids=4000)
    matrix = packed_ids.read_packed(spark, str(tmp_path / "m"))
    _check(packed_ids.unpacked(matrix).collect(), enumerate(TEXTS))
    ref = _reference()
    whole = defaultdict(dict)
    for r in matrix.collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 1024 and len(r.positions) == 2048
        for a, b, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.segments):
            whole[s.doc_id][s.start] = ids[a:b].tolist()
    for i, text in enumerate(TEXTS):
        assert sum((whole[i][s] for s in sorted(whole[i])), []) == ref(text)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bestfit_packing.packed_documents(none).count() == 0
    assert packed_ids.unpacked(packed_ids.packed_sequences(none)).count() == 0
