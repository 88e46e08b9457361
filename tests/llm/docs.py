"""Small document tables with the awkward cases, for the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, fp string, _row string"
OWN = ["doc_id", "text", "source"]


def documents(n=120, seed=5):
    """Random texts with exact copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Üé", "漢字", "Straße"]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = words(40)
    texts = []
    for i in range(n):
        text = words(rng.choice([1, 2, 5, 12, 13, 60, 90, 200]))
        if i % 7 == 0:
            at = rng.randrange(len(text))
            text[at:at] = passage[rng.randrange(10):]
        lines = []
        while text:
            k = rng.randint(1, 12)
            lines.append(rng.choice([" ", "  ", " \t"]).join(text[:k]))
            text = text[k:]
        if i % 9 == 0:
            lines[1:1] = ["the same line here.", "and the one after it", "a third for good measure"]
        texts.append("\n".join(lines))
    for i in range(0, n, 5):
        texts[i] = texts[rng.randrange(n)]
    for i in range(3, n, 8):
        other = texts[rng.randrange(n)].split(" ")
        other[rng.randrange(len(other))] = "changed"
        texts[i] = " ".join(other)
    rows = [(i, x, "en", f"s{i % 4}" if i % 11 else None, len(x)) for i, x in enumerate(texts)]
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, " \n\t\n ", "de", "s2", 5), (903, "one", "en", "s9", 3), (904, "a b", "en", "", 3)]
    rows += [(905, " ".join(words(9000)), "en", "s1", 1), (906, "x" * 50000, "en", "s1", 1), rows[3], rows[3]]
    return [(*row, "clash", "clash", "clash", "clash") for row in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
