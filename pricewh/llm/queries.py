"""Registered queries of the operators, and DuckDB SQL where it can say the same.

Each query applies its operator to whole tables and derives digest columns from what it returns.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.llm import (
    attention_lm, bpe, chat_format, conversation_repair, embedding_dedup, exact_dedup, license_scan, line_dedup, ngram_join,
    packing, ranked_search, toxicity, url_filter)
from pricewh.llm.license_templates import BASE_PHRASES, NAMED, TEMPLATES
from pricewh.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
CONTROL_TALK = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op1_line_dedup"] = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                                                       '[\x20\x09-\x0D]+$', ''), '{UPPER}', '{LOWER}') AS key FROM l),
h AS (SELECT key, min(doc_id) AS holder FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, h.holder IS NOT NULL AND k.doc_id > h.holder AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c <> 0)) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id < b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT vec_id AS d, vec_id AS t FROM embeddings UNION SELECT r.d, u.b FROM r JOIN u ON r.t = u.a),
c AS (SELECT d, min(t) AS component_id FROM r GROUP BY d),
n AS (SELECT a, count(*) AS n FROM u GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = d LEFT JOIN n ON vec_id = a"""


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE["op3_exact_dedup"] = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


_FITS = " ".join(
    f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{{{i}}}'"
    for i, (h, p, _) in sorted(enumerate(URL_RULES), key=lambda r: -len(r[1][0] + r[1][1])))
ORACLE["op5_url_filter"] = f"""
WITH r AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
SELECT page_id, host, path, CASE {_FITS.format(*(h + p for h, p, _ in URL_RULES))} END AS rule,
       CASE {_FITS.format(*(v for _, _, v in URL_RULES))} ELSE 'allow' END AS verdict
FROM p"""


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TALK, talks.schema)
    return chat_format.read_chat(chat_format.format_chat(talks.unionByName(extra)))


#: Lengths of the template's marks around a turn: start, separator, end and line break.
_MARKS = len(chat_format.START) + len(chat_format.SEP) + len(chat_format.END) + 1
_CONTROL = "[<\\[]\\\\*(?:" + "|".join(
    "".join("\\" + ch if ch in "|[]/" else ch for ch in c[1:]) for c in chat_format.CONTROL) + ")"
ORACLE["op6_chat_format"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES {', '.join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in CONTROL_TALK)})
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(role) + length(text) + {_MARKS} + len(regexp_extract_all(role, '{_CONTROL}'))
                + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_documents(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score",
                                                        "predicted")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, of=85, out_of=100)


_WORDS = "[w FOR w IN regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+') IF w <> '']"
ORACLE["op9_ngram_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
             WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS f FROM w),
e AS (SELECT doc_id, len(f) AS n, unnest(f) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (n + m - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS t FROM s UNION SELECT r.d, u.b FROM r JOIN u ON r.t = u.a)
SELECT s.doc_id, CAST(len(f) AS BIGINT) AS n_shingles, min(r.t) AS component_id
FROM s JOIN r ON s.doc_id = r.d GROUP BY ALL"""


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY)


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                        table(spark, sf_dir, "benchmark", "item_id", "text"), top=10)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(
    UPPER, LOWER)
ORACLE["op11_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
f AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest({_TERMS}) AS term FROM d) GROUP BY ALL),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, c GROUP BY term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))
             AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (r), c GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
             AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


def damaged(talks: DataFrame) -> DataFrame:
    """Conversation rows with faults dealt by crc32(conv_id:turn) % 20; rows that go are marked ``dropped``."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return (talks.withColumn("fault", fault)
            .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", ""))
                    .otherwise(text).alias("text"), (F.col("fault") == 0).alias("dropped")))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.report(conversation_repair.repair(damaged(talks), "dropped"))


#: crc32 of an ASCII string, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
  string_split({}, ''), lambda c: list_prepend(CAST(ascii(c) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""
ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE g AS (SELECT DISTINCT conv_id FROM conversations),
b AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(g.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
      FROM conversations t JOIN (SELECT conv_id, row_number() OVER () AS c FROM g) g ON t.conv_id IS NOT DISTINCT FROM g.conv_id),
e AS (SELECT *, {_CRC32.format('k')} % 20 AS m FROM b),
d AS (SELECT c, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
             CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT *, unnest(CASE m WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) FROM e)),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
r AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS x,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
             WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
             WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 't' ELSE '' END AS fault FROM o),
p AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
             count(*) FILTER (WHERE fault = 't') AS truncated, count(*) AS n FROM r GROUP BY c),
j AS (SELECT c, count(*) FILTER (WHERE y || x NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT c, x, lag(x) OVER (PARTITION BY c ORDER BY i) AS y FROM r) GROUP BY c),
ins(f, t, k) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
nxt(f, sym, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
acts AS MATERIALIZED (
  SELECT c, i, 'D' AS edit, NULL AS sym, 2 AS cost FROM r
  UNION ALL SELECT c, i, 'K', x, CASE fault WHEN 't' THEN 5 ELSE 0 END FROM r WHERE fault NOT IN ('b', 'd')
  UNION ALL SELECT c, i, 'R', s, 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END FROM r, (VALUES ('u'), ('a')) v(s)
            WHERE fault NOT IN ('b', 'd')),
dp AS (SELECT c, CAST(0 AS BIGINT) AS i, 0 AS st, '0000000000' AS v FROM p
       UNION ALL
       SELECT c, i, st, min(v) FROM (
         SELECT a.c, a.i, CASE WHEN a.edit = 'D' THEN ins.t ELSE nxt.t END AS st,
                lpad(CAST(CAST(left(v, 10) AS BIGINT) + 5 * k + cost AS VARCHAR), 10, '0') || substr(v, 11) || repeat('I', k) || edit AS v
         FROM dp JOIN acts a ON a.c = dp.c AND a.i = dp.i + 1 JOIN ins ON ins.f = dp.st
              LEFT JOIN nxt ON nxt.f = ins.t AND nxt.sym = a.sym
         WHERE a.edit = 'D' OR nxt.t IS NOT NULL) GROUP BY c, i, st),
z AS (SELECT dp.c, min(lpad(CAST(CAST(left(v, 10) AS BIGINT) + 5 * k AS VARCHAR), 10, '0') || substr(v, 11) || repeat('I', k)) AS v
      FROM dp JOIN p ON p.c = dp.c AND p.n = dp.i JOIN ins ON ins.f = dp.st WHERE ins.t IN (0, 3) GROUP BY dp.c),
u AS (SELECT c, generate_subscripts(string_split(substr(v, 11), ''), 1) AS q, unnest(string_split(substr(v, 11), '')) AS edit
      FROM z WHERE length(v) > 10),
w AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY c ORDER BY q) AS at FROM u),
y AS (SELECT w.c, q, edit, x, role, text, row_number() OVER (PARTITION BY w.c ORDER BY q) AS nth,
             first_value(edit = 'K' AND x = 's') OVER (PARTITION BY w.c ORDER BY q) AS opened
      FROM w LEFT JOIN r ON edit <> 'I' AND r.c = w.c AND r.i = w.at WHERE edit <> 'D'),
t AS (SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth + CAST(opened AS INT)) % 2 = 1 THEN 'user'
                                       ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY q)) AS sha
      FROM (SELECT c, q, edit, role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, nth, opened FROM y) GROUP BY c)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(left(v, 10) AS BIGINT), 0) AS cost, coalesce(substr(v, 11), '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT conv_id, row_number() OVER () AS c FROM g) g LEFT JOIN p USING (c) LEFT JOIN j USING (c) LEFT JOIN z USING (c)
     LEFT JOIN t USING (c)"""


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("found", lambda f: f["base"])
    names = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.aggregate(base, F.lit(0).cast("bigint"), lambda n, f: n + f["places"]).alias("n_base"),
        F.array_min(F.transform(base, lambda f: f["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f["last_word"])).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["strength"])), F.lit(0.0)).alias("score"))


def template_pattern(markup: str) -> str:
    """A template as a regular expression over words that are each followed by one space."""
    def words(text):
        return "".join(w + " " for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))

    def piece(m):
        if m[1] is None:
            return words(m[0])
        kind, _, value = m[1].partition("=")
        if kind == "beginOptional":
            return "(?:"
        if kind == "endOptional":
            return ")?"
        if kind == "var;any":
            return "(?:" + "|".join(map(words, value.split("|"))) + ")"
        return "(?:[^ ]+ ){%s}" % value.replace("..", ",")
    return re.sub(r"<<(.*?)>>|(?:(?!<<).)+", piece, markup, flags=re.DOTALL)


_LABELLED = ", ".join(f"CASE WHEN regexp_matches(norm, ' {template_pattern(t)}') THEN '{la}' END" for la, _, t in TEMPLATES)
_STRENGTH = " ".join(f"WHEN regexp_matches(norm, ' {template_pattern(t)}') THEN {s:.2f}"
                     for _, s, t in sorted(TEMPLATES + [("", NAMED, p) for _, p in BASE_PHRASES], key=lambda x: -x[1]))
_PLACES = " || ".join(
    "[{{'w': i - 1, 'label': '{}'}} FOR i IN range(1, len(ws) + 1) IF {}]".format(
        la, " AND ".join(f"ws[i + {k}] = '{w}'" if k else f"ws[i] = '{w}'" for k, w in enumerate(p.split())))
    for la, p in BASE_PHRASES)
ORACLE["op13_license_scan"] = f"""
WITH w AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
b AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS norm, {_PLACES} AS base FROM w),
x AS (SELECT *, [e.label FOR e IN base] AS mine, [e.w FOR e IN base] AS spots,
             list_filter([{_LABELLED}], lambda v: v IS NOT NULL) AS more FROM b)
SELECT doc_id, len(ws) AS n_words, len(base) AS n_base, CAST(list_min(spots) AS BIGINT) AS first_word,
       CAST(list_max(spots) AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(list_distinct(mine)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(mine || more)), ','), '') AS labels,
       CAST(CASE {_STRENGTH} ELSE 0 END AS DOUBLE) AS score
FROM x"""
