"""The pipeline against a chain of plain brute-force stages."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

import corpus_pipeline
from tessera.llm import mixing
from tessera.llm.tokens import piece_bounds

from .test_near_dedup import brute as near_groups
from .test_packing import _reference


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(900001, "12 + 3 = ?", "en", "src1", 10), (900002, None, "en", "src1", None),
           (900003, "  ", None, None, 2)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
                  for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    rows = [r.asDict() for r in docs.collect()]
    rows = [r for r in rows if re.search(r"[^\W\d_]", r["text"] or "")]
    texts = {}
    for r in sorted(rows, key=lambda r: (-len(r["text"]), r["doc_id"])):
        texts.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r["text"]), r)
    rows = list(texts.values())
    groups = near_groups([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if groups[r["doc_id"]][1] == r["doc_id"]]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(rows))
    taken = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken FROM ({mixing.ORACLE})").fetchall()}
    encode, want = _reference(), Counter()
    for r in rows:
        left, words = taken[r["doc_id"]], re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        while left > 0:
            left -= len(words)                    # the last copy stays whole too
            ids = np.array(encode(r["text"]), "<u4")
            for k, (s, n) in enumerate(piece_bounds(len(ids))):
                want[r["doc_id"], k, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    assert got == want


def test_stages_return_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0
