"""Texts that hold the string of an added token, against the tokenizer as it is."""

import zlib

import numpy as np
from tokenizers import Tokenizer

from tessera.llm import bestfit_packing, packed_ids
from tessera.llm.tokens import default_vocabulary, encoder, piece_bounds

END = "<|endoftext|>"
TEXTS = [END, f"a {END} in text", f"{END}{END} x", f"a  {END}  b\n{END}", f"<|endoftext|{END}|>",
         f"word{END}word " * 700, "<|endoftext| >", "one two", None]


def _reference(text):
    tokenizer = Tokenizer.from_file(default_vocabulary())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_added_tokens_are_single_ids():
    got = [i.tolist() for i in encoder(default_vocabulary()).encode(TEXTS)]
    assert got == [_reference(t) for t in TEXTS]
    assert got[1] == [64, 220, 50256, 287, 2420, 2]


def test_packing_holds_them(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = []
    for i, text in enumerate(TEXTS):
        ids = np.array(_reference(text), "<u4")
        want += [(i, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                 for k, (s, n) in enumerate(piece_bounds(len(ids)))]
    for out in (bestfit_packing.packed_documents(docs),
                packed_ids.unpacked(packed_ids.packed_sequences(docs))):
        rows = out.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
        assert sorted(map(tuple, rows)) == want
