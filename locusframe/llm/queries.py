"""Registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.llm import chat, decontam, graph_dedup, langid, ngram_join, packing, phrases, revisits, rule_ledger, shards, toxicity, urls, whitening
from locusframe.llm.common import id_bucket, stored, table
from locusframe.plans.registry import Query

SHARDS = 8


def op1(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2(spark, sf_dir):
    return graph_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", id_bucket("doc_id", 5) == 0)
    model = langid.train_language_model(docs.where("not held_out"))
    return langid.identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


def op4(spark, sf_dir):
    placed = shards.shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digest(chat.format_records(chat.records_of(rows.unionByName(extra))))


OP5_SQL = r"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (SELECT *, length(role)+length(text)+length(regexp_replace(role||text, '[^\\<\[]', '', 'g')) AS coded FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role||chr(10)||text||chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role='assistant'), '') AS loss,
             string_agg(role, chr(10) ORDER BY turn, role, text) AS roles, bool_or(role IN ('human','gpt')) AS odd,
             CAST(sum(coded)+count(*)*(length('<|turn|>')+length('<|text|>')+length('<|end|>')) AS BIGINT) AS formatted_chars FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       CASE WHEN roles='user'||chr(10)||'assistant' THEN 'prompt' WHEN roles='system'||chr(10)||'user'||chr(10)||'assistant' THEN 'instruction'
            WHEN ((coalesce(conv_id,0)%2)+2)%2=0 AND NOT odd THEN 'shared' ELSE 'messages' END AS layout
FROM g"""

def op6(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    lexicon = toxicity.train_lexicon(docs, labels.where(id_bucket("doc_id", 4) != 2))
    return toxicity.score_texts(docs.withColumn("held_out", id_bucket("doc_id", 4) == 2), lexicon).select("doc_id", "held_out", "score", "predicted")


def op8(spark, sf_dir):
    found = revisits.resolve_revisits(revisits.captures_of(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("record_id", "url_key", "response_id", "outcome", F.array_join(lines, "\n").alias("headers"))


OP8_SQL = r"""
WITH p AS (SELECT page_id AS pid, coalesce(url,'') AS url, md5(coalesce(html,'')) AS m, 1700000000+page_id*7 AS ts FROM pages),
b AS (SELECT *, '"'||substring(m,1,16)||'"' AS et, CAST(ts-pid%1000 AS VARCHAR) AS lm, regexp_replace(regexp_replace(url,'#.*$',''),'^http:','https:') AS sp FROM p),
cap AS (
 SELECT pid*8 AS record_id, 'response' AS kind, url, ts, 200 AS status, et AS etag, lm AS last_modified, m AS digest,
  [{'k':'content-type','v':'text/html'},{'k':'etag','v':et},{'k':'cache-control','v':'max-age=60'},{'k':'date','v':CAST(ts AS VARCHAR)},{'k':'set-cookie','v':'a=1'}] AS h FROM b
 UNION ALL SELECT pid*8+1, 'revisit', sp||CASE WHEN contains(sp,'?') THEN '&' ELSE '?' END||'utm_medium=x#top', ts+3600*(1+pid%50), 304, et, NULL, NULL,
  [{'k':'date','v':CAST(ts+3600 AS VARCHAR)},{'k':'cache-control','v':'max-age=120'},{'k':'etag','v':et}] FROM b
 UNION ALL SELECT pid*8+2, 'revisit', url, ts+90000+pid%7, 304, CASE WHEN pid%7=0 THEN '"other"' END, CASE WHEN pid%3=0 THEN lm END, CASE WHEN pid%2=0 THEN m END,
  [{'k':'date','v':CAST(ts+90000 AS VARCHAR)},{'k':'expires','v':CAST(ts+99000 AS VARCHAR)}] FROM b
 UNION ALL SELECT pid*8+4, 'revisit', sp, ts-1000000, 304, et, NULL, NULL, [{'k':'date','v':CAST(ts-1000000 AS VARCHAR)}] FROM b WHERE pid%11=0),
c AS (SELECT *, regexp_replace(url,'#.*$','') AS u FROM cap),
k AS (SELECT *, CASE WHEN regexp_matches(u,'^[^:/?]*://') THEN
   regexp_replace(regexp_replace(lower(regexp_extract(u,'^[^:/?]*://([^/?]*)',1)),':(80|443)$',''),'^www\.','')
   ||regexp_replace(regexp_extract(u,'^[^:/?]*://[^/?]*([^?]*)',1),'/+$','')
   ||CASE WHEN len(q)>0 THEN '?'||array_to_string(q,'&') ELSE '' END END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(u,'\?(.*)$',1),'&'), lambda x: x<>'' AND NOT regexp_matches(x,'^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))) AS q FROM c)),
w AS (SELECT *, last_value(CASE WHEN kind='response' THEN {'id':record_id,'etag':etag,'lm':last_modified,'d':digest,'h':h} END IGNORE NULLS)
        OVER (PARTITION BY url_key ORDER BY ts, CASE WHEN kind='revisit' THEN 0 ELSE 1 END, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM k),
o AS (SELECT *, CASE WHEN url_key IS NULL OR r IS NULL THEN 'no-response'
   WHEN etag IS NOT NULL AND r.etag IS NOT NULL THEN CASE WHEN etag=r.etag THEN 'etag' ELSE 'changed' END
   WHEN last_modified IS NOT NULL AND r.lm IS NOT NULL THEN CASE WHEN last_modified=r.lm THEN 'last-modified' ELSE 'changed' END
   WHEN digest IS NOT NULL AND r.d IS NOT NULL THEN CASE WHEN digest=r.d THEN 'digest' ELSE 'changed' END ELSE 'no-validator' END AS outcome FROM w WHERE kind='revisit')
SELECT record_id, url_key, CASE WHEN outcome IN ('etag','last-modified','digest') THEN r.id END AS response_id, outcome,
  CASE WHEN outcome IN ('etag','last-modified','digest') THEN array_to_string(list_sort(list_concat(
    list_transform(h, lambda x: x.k||'='||x.v), list_transform(list_filter(r.h, lambda x: NOT list_contains(list_transform(h, lambda y: y.k), x.k)), lambda x: x.k||'='||x.v))), chr(10)) END AS headers
FROM o"""


def op9(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return decontam.contaminated(docs, benchmark).select("doc_id", "item_id", "coverage", "tiled_words", "tiles", "longest_tile", "doc_words")


URL_RULES = [
    urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"),
]


def op10(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op11(spark, sf_dir):
    ledger = stored(rule_ledger.quality_ledger(table(spark, sf_dir, "documents")))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~rule_ledger.kept_by(rule_ledger.BASE)).alias("base_failed"),
        rule_ledger.kept_by(rule_ledger.STANDARD).alias("kept"), "n_lines", "n_ended_lines", "n_letter_words", "failed")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT rid, generate_subscripts(w, 1) AS pos, unnest(w) AS a FROM s),
q AS (SELECT rid, pos, a, lead(a, 1) OVER (PARTITION BY rid ORDER BY pos) AS b, lead(a, 2) OVER (PARTITION BY rid ORDER BY pos) AS c FROM p),
r AS (SELECT rid, pos FROM q WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
v AS (SELECT rid, count(DISTINCT pos + k) AS n FROM r, (VALUES (0), (1), (2)) AS x(k) GROUP BY rid),
m AS (SELECT s.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(len(list_filter(ls, lambda x: regexp_matches(x, '[.!?":;,)][\x20\x09-\x0D]*$'))) AS BIGINT) AS n_ended_lines,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS BIGINT) AS n_letter_words FROM s LEFT JOIN v ON v.rid = s.rid),
f AS (SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (word_chars < 3 * n_words)::INT + 8 * (word_chars > 10 * n_words)::INT
  + 16 * (100 * n_symbols > 10 * n_words)::INT + 32 * (100 * n_dup_lines > 40 * n_lines)::INT + 64 * (100 * n_letter_words < 80 * n_words)::INT
  + 128 * (n_lines > 1 AND 100 * n_ended_lines < 10 * n_lines)::INT + 256 * (n_dup_lines > 0)::INT + 512 * (n_words > 100000)::INT AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, (failed & 255) = 0 AS kept, n_lines, n_ended_lines, n_letter_words, failed
FROM f"""


def op12(spark, sf_dir):
    return phrases.collocations(stored(phrases.frequent_phrases(table(spark, sf_dir, "documents"))))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT rid, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]'), 1) AS pid FROM d),
w AS (SELECT rid, lang, pid, unnest(ws) AS a, generate_subscripts(ws, 1) AS pos FROM (SELECT rid, lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM s)),
g AS (SELECT lang, a, lead(a, 1) OVER (PARTITION BY rid, pid ORDER BY pos) AS b, lead(a, 2) OVER (PARTITION BY rid, pid ORDER BY pos) AS c,
  lead(a, 3) OVER (PARTITION BY rid, pid ORDER BY pos) AS e, lead(a, 4) OVER (PARTITION BY rid, pid ORDER BY pos) AS h FROM w),
u AS (SELECT lang, 1 AS len, a AS phrase FROM g UNION ALL SELECT lang, 2, a||' '||b FROM g WHERE b IS NOT NULL UNION ALL SELECT lang, 3, a||' '||b||' '||c FROM g WHERE c IS NOT NULL
  UNION ALL SELECT lang, 4, a||' '||b||' '||c||' '||e FROM g WHERE e IS NOT NULL UNION ALL SELECT lang, 5, a||' '||b||' '||c||' '||e||' '||h FROM g WHERE h IS NOT NULL),
f AS (SELECT lang, len, phrase, count(*) AS f FROM u GROUP BY lang, len, phrase HAVING count(*) >= 100),
t AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
x AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, len)) AS k FROM f WHERE len >= 2),
y AS (SELECT x.lang, x.phrase, x.a, x.k, l.f AS l, r.f AS r, t.n, (CAST(1000 AS HUGEINT) * x.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS score FROM x
  JOIN f AS l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:x.k], ' ') JOIN f AS r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[x.k+1:], ' ') JOIN t ON t.lang = x.lang),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
v AS (SELECT * FROM z WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = z.lang AND f.len > len(string_split(z.phrase, ' ')) AND 100 * f.f >= 100 * z.a AND contains(' '||f.phrase||' ', ' '||z.phrase||' ')))
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM v) WHERE rank <= 2000"""


def op13(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {
    "op1_ngram_join": Query(op1),
    "op2_graph_dedup": Query(op2),
    "op3_langid": Query(op3),
    "op4_shards": Query(op4),
    "op5_chat": Query(op5, OP5_SQL),
    "op6_packing": Query(op6),
    "op7_toxicity": Query(op7),
    "op8_revisits": Query(op8, OP8_SQL),
    "op9_decontamination": Query(op9),
    "op10_urls": Query(op10),
    "op11_quality_rules": Query(op11, OP11_SQL),
    "op12_phrases": Query(op12, OP12_SQL),
    "op13_whitening": Query(op13),
}
