import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from spantrack.llm import bpe
from tests.llm.docs import documents, frame


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(open(bpe.VOCABULARY, "rb").read())


def test_pieces(own, library):
    rng = random.Random(2)
    kinds = ["abcdeilnorst", "aé漢ñß字ü", "a", "ab", "0123456789", "=-_#", "ThequickBROWNfox", " \n\t", "аеиностр", "🙂👩‍👩‍👧é"]
    for i in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([1, 3, 9, 20, 40, 90]))) if i % 2 else rng.choice(["", " "]) + "".join(rng.choice(kinds[i % len(kinds)]) for _ in range(rng.choice([2, 7, 18, 33, 70, 200])))
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_long_runs(own, library):
    for text in ("x" * 20000, "ab" * 7000 + "c", "=" * 5000, " " * 3000 + "a", "é漢" * 2000):
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_join_is_associative(own):
    rng = random.Random(4)
    for _ in range(400):
        a, b, c = ("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(0, 25))).encode() for _ in range(3))
        x, y, z = map(own.merged, (a, b, c))
        assert own.join(own.join(x, y), z) == own.join(x, own.join(y, z)) == own.merged(a + b + c) == tuple(own._merged_long(a + b + c))


def test_documents(spark, library):
    rows = [*documents(), (910, "<|endoftext|> 's 'LL \u00a0\u2003x\r\n", *[None] * 7)]
    docs = frame(spark, rows)
    out = bpe.decode(bpe.encode(docs))
    assert out.columns == [*docs.columns, "ids", "decoded"]
    got = out.collect()
    assert sorted(got) == sorted(bpe.encode(docs, decoded="decoded").collect())
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((r[0], library.encode_ordinary(r[1] or "")) for r in rows)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in got)
    assert bpe.decode(bpe.encode(frame(spark, []))).count() == 0
