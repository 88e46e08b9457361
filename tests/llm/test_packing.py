import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spantrack.llm import packing
from tests.llm.docs import SCHEMA, documents, frame

ODD = ["", " ", "  two  spaces ", "\n a\n\n b \t c", "tab\tand nbsp  x", "a <|endoftext|> b", "<|endoftext|>", "x" * 9000, "漢字" * 700, "it's  we'll\r\n 'd", " \u001c a", "a \u001cb", "end \n"]


def tokens(texts):
    own = Tokenizer.from_file(packing.VOCABULARY)
    return [[*own.encode(x or "", add_special_tokens=False).ids, packing.END_ID] for x in texts]


def test_lengths():
    for most in (1, 8, 2048):
        for n in [*range(1, 70), 2047, 2048, 2049, 5000]:
            got = packing.lengths(n, most)
            assert sum(got) == n and all(x & (x - 1) == 0 and x <= most for x in got) and len({x for x in got if x < most}) == len([x for x in got if x < most])


def test_units_encode_like_whole_texts():
    own = packing.Encoder(open(packing.VOCABULARY, encoding="utf-8").read())
    for x in ODD:
        assert np.frombuffer(own.encode([x])[0], "<u4").tolist() == tokens([x])[0][:-1], x


@pytest.mark.parametrize("most", [2048, 32])
def test_brute_force(spark, most):
    rows = documents() + [(2000 + i, x, *["en"] * 2, 0, *["clash"] * 4) for i, x in enumerate(ODD)]
    got = packing.pack(frame(spark, rows).repartition(5), most=most).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    want = dict(zip([r[0] for r in rows], tokens([r[1] for r in rows]), strict=True))
    times = {r[0]: sum(x[0] == r[0] for x in rows) for r in rows}
    assert set(by_doc) == set(want)
    for doc_id, ids in want.items():
        own = sorted(by_doc[doc_id], key=lambda r: r.start)
        starts = np.concatenate([[0], np.cumsum(packing.lengths(len(ids), most))[:-1]]).tolist()
        assert [r.start for r in own] == [x for x in starts for _ in range(times[doc_id])]
        for r in own:
            piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids == piece and r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(ids) and r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= most
    ordered = sorted(got, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in ordered] == list(range(len(got)))
    assert [r.length for r in ordered] == sorted((r.length for r in got), reverse=True)


def test_buckets(spark, tmp_path):
    docs = frame(spark, documents(30))
    packing.write_buckets(packing.pack(docs), str(tmp_path / "b"))
    read = spark.read.parquet(str(tmp_path / "b"))
    assert read.where("bucket <> length OR octet_length(ids) <> 4 * length").count() == 0
    assert read.agg(F.sum("length")).first()[0] == sum(len(x) for x in tokens([r[1] for r in documents(30)]))


def test_awkward_tables(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert [(r.doc_id, r.length, r.ids) for r in packing.pack(one).collect()] == [(None, 1, b"\1\0\0\0")] * 2
    with pytest.raises(ValueError):
        packing.pack(one, most=100)
