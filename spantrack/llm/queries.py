"""Queries over the driver's tables for the operators of this package, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spantrack.llm import align, bpe, chat, lines, merkle, mixing, packing, quality, secrets, simhash, substrings, topk, toxicity
from spantrack.llm._spark import table

#: The conversation that op5 adds, whose texts hold the template's own markers.
MARKED = -7, r"\### Assistant: </turn> ok"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, decoded="decoded")
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(MARKED[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED[1]).alias("text"))
    out = chat.read_back(chat.formatted(chat.turns_of_rows(rows.unionByName(own))))
    said = F.array_join(F.transform("read_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("read_loss").cast("long").alias("loss_chars"),
        F.sha2("read_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "fingerprint",
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.dedup_lines(docs, removed="n_removed", shared="shared_lines")
    return out.select("doc_id", "n_removed", "shared_lines", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("n_lines", "rejected_by")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(table(spark, sf_dir, "documents"), texts=False)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), ids=False)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.tampered(F.col("n_chars")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(table(spark, sf_dir, "documents"))


QUERIES = (op1_toxicity, op2_mix, op3_bpe, op4_topk, op5_chat, op6_secrets, op7_lines, op8_quality, op9_substrings, op10_simhash, op11_pack, op12_manifest, op13_align)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*QUERIES, pipeline)}


# Vectors of finite components only; every row but the query's own is a candidate; sizes and scores are exact integers.
TOP_K = """
WITH q AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.row AS own, a.vec_id AS query_id, b.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM q a JOIN q b ON a.row <> b.row WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

# Windows of two lines with a word, and lines of 13 words or more; all but the first of equal ones go. Shared runs: lists of line hashes of every length.
LINES = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS ln FROM d),
w AS (SELECT doc_id, line, ln, lead(line) OVER o AS nxt, lead(ln) OVER o AS next_ln
      FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') WINDOW o AS (PARTITION BY doc_id ORDER BY ln)),
r AS (SELECT *, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, ln) AS n FROM w WHERE next_ln IS NOT NULL),
u AS (SELECT doc_id, ln, row_number() OVER (PARTITION BY line ORDER BY doc_id, ln) AS n FROM w WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 13),
gone AS (SELECT doc_id, ln FROM r WHERE n > 1 UNION SELECT doc_id, next_ln FROM r WHERE n > 1 UNION SELECT doc_id, ln FROM u WHERE n > 1),
k AS (SELECT l.doc_id, string_agg(CASE WHEN g.ln IS NULL THEN l.line END, chr(10) ORDER BY l.ln) AS kept, count(g.ln) AS n
      FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.ln = g.ln GROUP BY l.doc_id),
a AS (SELECT doc_id, array_agg(hash(line) ORDER BY ln) AS hs FROM w GROUP BY doc_id),
x AS (SELECT doc_id, n, list_slice(hs, i + 1, i + n) AS run FROM (SELECT doc_id, hs, n, unnest(range(len(hs) - n + 1)) AS i FROM (SELECT doc_id, hs, unnest(range(1, len(hs) + 1)) AS n FROM a))),
y AS (SELECT n, run FROM x GROUP BY n, run HAVING count(*) > 1),
z AS (SELECT doc_id, max(n) AS shared_lines FROM x JOIN y USING (n, run) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(z.shared_lines, 0) AS BIGINT) AS shared_lines,
       CAST(length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END) AS BIGINT) AS kept_chars,
       sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN z ON d.doc_id = z.doc_id
"""


# The turns' texts, and the template's length: markers, and a backslash before each backslash, # and / after <.
CHAT = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT {MARKED[0]}, 0, 'user', '{MARKED[1]}' UNION ALL SELECT {MARKED[0]}, 1, 'assistant', '{MARKED[1]}'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat.BEGIN) + 1 + len(chat.END)} + length(role) + length(text) + length(regexp_replace(text, '[^\\#]', '', 'g'))
                + (length(text) - length(replace(text, '</', ''))) // 2) AS BIGINT) AS formatted_chars,
       '{chat.fingerprint("OBJECT<turns: ARRAY<OBJECT<role: _, text: _>>>")}' AS fingerprint
FROM t GROUP BY conv_id
"""

WORDS = r"""d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d)"""

QUALITY = rf"""
WITH {WORDS},
t AS (SELECT doc_id, i, string_agg(word, ' ') OVER o AS k, count(*) OVER o AS n FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
r AS (SELECT doc_id, i, n = 3 AND count(*) FILTER (WHERE n = 3) OVER (PARTITION BY doc_id, k) > 1 AS hit FROM t),
v AS (SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM r),
n AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n_repeat_words FROM v GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id))
SELECT * EXCLUDE (n_lines), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 20 * n_symbols > word_chars OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM m
"""

PASSAGES = rf"""
WITH {WORDS},
t AS (SELECT doc_id, i, word, string_agg(word, ' ') OVER o AS k, count(*) OVER o AS n FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
f AS (SELECT doc_id, i, word, n = 13 AND min(doc_id) FILTER (WHERE n = 13) OVER (PARTITION BY k) < doc_id AS hit FROM t),
v AS (SELECT doc_id, i, word, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM v GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


# Leaves by lang in order of doc_id, then every level of both trees; a proof's siblings with their side, folded from the leaf up.
_FIELDS = "d.doc_id", "d.source", "d.lang", "{n_chars}", "d.text"
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')" for x in _FIELDS) + ")"
_CRC = "xor(list_reduce(list_transform(string_split(CAST(d.doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, b)), 4294967295), 4294967295)"
MANIFEST = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce('+' || lang, '') AS g, {_LEAF.format(n_chars="d.n_chars")} AS leaf,
   CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_LEAF.format(n_chars="(d.n_chars + 1)")} END AS changed FROM documents d),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
t AS (SELECT g, 0 AS lev, pos, n AS m, leaf AS h FROM p
      UNION ALL SELECT g, lev + 1, pos // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE m > 1 GROUP BY g, lev, pos // 2, m),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE m = 1),
u AS (SELECT 0 AS lev, pos, n AS m, subroot AS h FROM s
      UNION ALL SELECT lev + 1, pos // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE m > 1 GROUP BY lev, pos // 2, m),
lower AS (SELECT p.g, p.pos, list(CASE WHEN o.h IS NULL THEN 'n' WHEN o.pos % 2 = 0 THEN 'l' || o.h ELSE 'r' || o.h END ORDER BY a.lev) AS way
      FROM p JOIN (SELECT DISTINCT g, lev FROM t WHERE m > 1) a ON a.g = p.g LEFT JOIN t o ON o.g = p.g AND o.lev = a.lev AND o.pos = xor(p.pos // CAST(pow(2, a.lev) AS BIGINT), 1) GROUP BY p.g, p.pos),
upper AS (SELECT s.g, list(CASE WHEN o.h IS NULL THEN 'n' WHEN o.pos % 2 = 0 THEN 'l' || o.h ELSE 'r' || o.h END ORDER BY a.lev) AS way
      FROM s JOIN (SELECT DISTINCT lev FROM u WHERE m > 1) a ON TRUE LEFT JOIN u o ON o.lev = a.lev AND o.pos = xor(s.pos // CAST(pow(2, a.lev) AS BIGINT), 1) GROUP BY s.g),
w AS (SELECT p.*, s.subroot, (SELECT h FROM u WHERE m = 1) AS root, coalesce(lower.way, []) || coalesce(upper.way, []) AS way
      FROM p JOIN s USING (g) LEFT JOIN lower ON lower.g = p.g AND lower.pos = p.pos LEFT JOIN upper ON upper.g = p.g),
f AS (SELECT *, list_reduce(way, lambda x, o: sha256(CASE o[1] WHEN 'l' THEN o[2:] || x WHEN 'r' THEN x || o[2:] ELSE x END), coalesce(changed, leaf)) AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda o: o[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_manifest": MANIFEST, "op4_topk": TOP_K, "op5_chat": CHAT, "op7_lines": LINES, "op8_quality": QUALITY, "op9_substrings": PASSAGES}
