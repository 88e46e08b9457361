from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from spantrack.llm import _units, align
from tests.llm.docs import SCHEMA, documents, frame

ODD = ["a▁b", " ", "  two  spaces ", "\n a\n\n b", "tab\tand nbsp", "a <|endoftext|> b </s>", "<0x0A>", "\x00z", "x" * 700, "漢字" * 90, "①é", "a \u001cb", " end \n", "https://a.b/c?d=e_f  0123456789abcdef"]


def groups(text, a, b):
    """Token ids of both sides and their groups, by the definition on whole texts."""
    chars = _units.byte_level()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    left = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
    right = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(left) != (" " + text).encode() or b"".join(right) != (" " + text).encode():
        return None
    ends = [np.cumsum([len(x) for x in side]) for side in (left, right)]
    cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    out = [([], []) for _ in cuts]
    for side, ids in enumerate((ids_a, ids_b)):
        for i, end in zip(ids, ends[side], strict=True):
            out[np.searchsorted(cuts, end)][side].append(i)
    return out


def brute(rows):
    a, b = Tokenizer.from_file(align.A_VOCABULARY), sentencepiece.SentencePieceProcessor(model_file=align.B_VOCABULARY)
    a.encode_special_tokens = True
    found = [(r[0], groups(r[1], a, b) if r[1] else None) for r in rows]
    links = [Counter((x, y) for xs, ys in own or [] for x in xs for y in ys) for _, own in found]
    counts, best = Counter(), defaultdict(int)
    for own in links:
        counts.update(set(own))
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, own), link in zip(found, links, strict=True):
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in own or [])
        sums = [sum(n for p, n in link.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in link.items())]
        out.append((doc_id, sum(len(x) for x, _ in own or []), sum(len(y) for _, y in own or []), len(own or []), sum(link.values()), *sums, sha256(shown.encode()).hexdigest() if own else ""))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_pairs": 50, "fan_in": 2}, {"shard_pairs": 300, "fan_in": 3, "broadcast_bytes": 0}])
def test_brute_force(spark, options):
    rows = documents(80) + [(2000 + i, x, "en", "s", 0, *["clash"] * 4) for i, x in enumerate(ODD)]
    assert result(align.aligned(frame(spark, rows).repartition(7), **options)) == brute(rows)


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 1000, 70_000):
        keys = np.unique(rng.integers(0, 2**36, n))
        own = align.PerfectHash(keys)
        assert sorted(own.index(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 2**36, 500), keys)
        ordered = np.empty_like(keys)
        ordered[own.index(keys)] = keys
        at = own.index(others)
        assert (at < len(keys)).all() and (ordered[at[at >= 0]] != others[at >= 0]).all()


def test_keys_are_verified():
    keys = np.arange(5, 500, 7)
    own = align.PerfectHash(keys)
    ordered = np.empty_like(keys)
    ordered[own.index(keys)] = keys
    index = align.Index(1, {0: (own.rounds, ordered, ordered * 2)}, np.zeros(1, np.int64))
    assert (index.counts(keys[::3]) == 2 * keys[::3]).all()
    with pytest.raises(ValueError):
        index.counts(np.array([6]))


@pytest.mark.parametrize("bound", [0, align.BROADCAST_BYTES])
def test_awkward_tables(spark, bound):
    assert align.aligned(spark.createDataFrame([], SCHEMA), broadcast_bytes=bound).count() == 0
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")]
    got = result(align.aligned(spark.createDataFrame(rows, "doc_id long, text string"), broadcast_bytes=bound))
    assert got == brute(rows) and [x[6] for x in got if x[1]] == [6, 6, 6]  # two links, each in three documents
