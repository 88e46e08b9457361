import random
import re

import numpy as np

from spantrack.llm import secrets
from spantrack.llm._text import words_of
from tests.llm.docs import documents, frame


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def planted(seed=8, n=400):
    rng = random.Random(seed)
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "a", "water", "über", "naïve", "stone.", "runs,", "漢字", "1999", "Mr."]) for _ in range(80)]
        if i % 2:
            words[rng.randrange(70)] = rng.choice([f"password={hexa(18)}", f'token = "{hexa(40)}"', f"AKIA{hexa(16).upper()}", f"API_KEY: {hexa(12)}", "token: short"])
        rows.append((2000 + i, " ".join(words), *[None] * 7))
    return rows


def test_base_spans_stay(spark):
    rows = documents()[:40] + planted()
    rows += [(5000, "ſecret=abcdefghij toKen=secret=abcdefgh token: api_key: abcdefgh1 password = 'a.b-c_d+/=", *[None] * 7), (5001, "é" * 50 + "f" * 40 + "AKIAAKIA" + "A" * 12, *[None] * 7), (None, "passwd:12345678", *[None] * 7)]
    got = secrets.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        spans = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans]
        assert [x for x in spans if x[1] < 3] == brute(text[r.doc_id]) and spans == sorted(spans)
        for a, _, b in (x for x in spans if x[1] == 3):
            piece = text[r.doc_id][a:b]
            assert piece == piece.strip() and all(b <= s or e <= a for s, _, e in brute(text[r.doc_id]))


def test_the_field_learns_the_shape(spark):
    """Secrets whose keyword the patterns don't know are found by the field; clean texts are left alone."""
    model = secrets.fit(frame(spark, planted()))
    rng = random.Random(1)
    clean = [(i, " ".join(rng.choice(["the", "water", "stone.", "runs,", "über", "1999"]) for _ in range(60)), *[None] * 7) for i in range(50)]
    new = [(100 + i, f"{clean[i][1]} passphrase={''.join(rng.choice('0123456789abcdef') for _ in range(18))} {clean[i][1]}", *[None] * 7) for i in range(20)]
    got = {r.doc_id: r.spans for r in secrets.scan(frame(spark, clean + new), model).collect()}
    assert not any(got[i] for i in range(50))
    assert sum(any(s.kind == "crf" for s in got[100 + i]) for i in range(20)) >= 18


def test_runs_equal_whole_viterbi():
    """Decoding runs between certain words gives what Viterbi over the whole text gives."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    model = secrets.Model([rng.normal(0, 1.5, (s + 1, 3)).astype(np.float32) for s in secrets.SIZES], rng.normal(0, 1, (3, 3)).astype(np.float32))
    texts = [r[1] for r in planted(3, 40)]
    for words in words_of(pa.array(texts)):
        doc, rows = words.of(), secrets.features(words)
        tags, score = model.tags(rows, doc), model.scores(rows)
        for k in range(len(words.first)):
            a, b = words.first[k], words.last[k]
            whole = model.viterbi(score[None, a:b])[0]
            weigh = lambda t: score[a:b][np.arange(b - a), t].sum() + sum(model.moves[x, y] for x, y in zip([0, *t], [*t, 0]))
            assert abs(weigh(whole) - weigh(tags[a:b])) < 1e-3


def test_no_examples(spark):
    assert secrets.fit(frame(spark, documents()[:20])) is None
    assert secrets.scan(frame(spark, [])).count() == 0


def test_held_out_secrets_without_their_names(spark):
    """Fitted on half of a real table, the field finds the other half's secrets where no pattern matches any more."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    model = secrets.fit(docs.where("doc_id % 2 = 0"))
    texts, hidden = {}, {}
    for r in docs.where("doc_id % 2 = 1").collect():
        out, at, found = "", 0, []
        for start, _, end in secrets.base_spans(r.text or ""):
            if start >= at:
                piece = re.sub("(?i)password|passwd|secret|token|api_?key", "reference", r.text[start:end], count=1)
                piece = "".join("x" if i % 16 == 15 and c.isalnum() else c for i, c in enumerate(piece))  # no 32 hex digits in a row
                out += r.text[at:start]
                found.append((len(out), len(out) + len(piece)))
                out, at = out + piece, end
        texts[r.doc_id], hidden[r.doc_id] = out + (r.text or "")[at:], found
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    meets = lambda span, others: any(span[0] < b and a < span[1] for a, b in others)
    base = {i: [(s.start, s.end) for s in x if s.kind != "crf"] for i, x in got.items()}
    own = {i: [(s.start, s.end) for s in x if s.kind == "crf"] for i, x in got.items()}
    left = [(i, x) for i, spans in hidden.items() for x in spans if not meets(x, base[i])]
    assert len(left) >= 50 and sum(meets(x, own[i]) for i, x in left) >= 0.9 * len(left)
    assert sum(not meets(x, hidden[i]) for i, spans in own.items() for x in spans) <= 0.05 * len(left)
