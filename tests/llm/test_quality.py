from spantrack.llm import quality
from tests.llm.docs import documents, frame


def brute(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = (text or "").split("\n")
    dup = sum(bool(x.encode().split()) and x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), dup, len(covered))


def junk():
    plain = (None, None, None, None, None, None, None)
    texts = ["a b c " * 30, "good words here\n" * 40, "#x| $y% " * 40, "x " * 80, "y" * 30 + " " + "long" * 9]
    texts += [" ".join(f"{a}{b}{c}" for a in "abcd" for b in "efgh" for c in "ijkl"), "a\nb\na\n \n \nb\nb "]
    return [(i, x, *plain) for i, x in enumerate(texts, 2000)]


def test_measures_and_verdict(spark):
    rows = [r for r in documents() if r[0] < 905] + junk()
    got = quality.judged(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {r[0]: brute(r[1]) for r in rows}
    for r in got:
        n, chars, symbols, dup, repeat = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert r.kept == (r.rejected_by is None) and not (r.kept and r.base_failed)
    assert {r.doc_id for r in got if r.doc_id >= 2000 and r.kept} == {2005}


def test_order_changes_nothing_but_the_first_rule(spark):
    docs = frame(spark, documents() + junk())
    ordered = quality.order_rules(docs)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in quality.RULES)
    a = {(r.doc_id, r.kept) for r in quality.judged(docs).collect()}
    b = {(r.doc_id, r.kept) for r in quality.judged(docs, quality.RULES[::-1], 3).collect()}
    assert a == b
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality.judged(docs).where("kept").collect())


def test_empty_table(spark):
    assert quality.judged(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


def test_order_follows_measured_cost(spark):
    """Two rules reject the same documents; the one whose measure takes longer goes last, whichever comes first."""
    slow = quality.Rule("slow", lambda m: m.n_words < sum(1 for _ in range(2000)) - 1950 and m.n_repeat_words >= 0)
    docs = frame(spark, documents() + junk())
    cheap = quality.Rule("cheap", lambda m: m.n_words < 50)
    for rules in ((slow, cheap), (cheap, slow)):
        assert [r.name for r in quality.order_rules(docs, rules)] == ["cheap", "slow"]
    found = quality.trials(docs, (slow, cheap))
    assert found["slow"][0] == found["cheap"][0] > 0
    assert set(found["slow"][1]) == {"words", "n_words", "n_repeat_words"} and set(found["cheap"][1]) == {"words", "n_words"}


def test_measures_of_an_earlier_rule_cost_nothing(spark, monkeypatch):
    found = {"a": (10, {"words": 100}), "b": (9, {"lines": 95}), "c": (5, {"words": 100, "n_words": 1})}
    monkeypatch.setattr(quality, "trials", lambda *_: found)
    rules = tuple(quality.Rule(x, lambda m: False) for x in "cba")
    assert [r.name for r in quality.order_rules(None, rules)] == ["a", "c", "b"]


def test_verdict_short_circuits(spark):
    m = quality.Timed(b"too short", spent := {})
    assert quality.RULES[0].rejects(m) and set(spent) == {"words", "n_words"}
    out = quality.judged(frame(spark, documents()), measures=())
    assert out.columns == ["doc_id", "base_failed", "rejected_by", "kept"]
