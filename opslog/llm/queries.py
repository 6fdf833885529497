"""Registered queries of the training-data operators, each over its whole table, and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers

from opslog.llm.best_fit import pack_documents
from opslog.llm.bpe import token_digests
from opslog.llm.cgk import find_leaks
from opslog.llm.chat_prefix import format_chats
from opslog.llm.common import read_table
from opslog.llm.html_blocks import extract_pages
from opslog.llm.k2_search import ranked_search
from opslog.llm.langid import predict_languages
from opslog.llm.line_dedup import dedup_lines
from opslog.llm.ngram_join import jaccard_components
from opslog.llm.prefix_hash import fingerprint_documents
from opslog.llm.prefix_trie import conversation_trie
from opslog.llm.quality_cnn import score_quality
from opslog.llm.superkmer import dedup_substrings
from opslog.plans.registry import query

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_quality_cnn")
def op1(spark, d):
    return score_quality(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


@query("op2_html_blocks")
def op2(spark, d):
    return extract_pages(read_table(spark, d, "pages"))


@query("op3_prefix_hash")
def op3(spark, d):
    return fingerprint_documents(read_table(spark, d, "documents"))


CHATS = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                  count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
named AS (SELECT conv_id, pos, n, md5(string_agg(coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)), chr(3))
                 OVER (PARTITION BY conv_id ORDER BY pos)) AS name FROM placed),
ends AS (SELECT n, name, min(conv_id) AS conv_id FROM named WHERE pos = n GROUP BY n, name),
kept AS (SELECT conv_id FROM ends e WHERE NOT EXISTS (SELECT 1 FROM named x WHERE x.pos < x.n AND x.pos = e.n AND x.name = e.name))
SELECT conv_id, CAST(0 AS INTEGER) AS part, max(n) AS n_turns,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM placed SEMI JOIN kept USING (conv_id) GROUP BY conv_id
"""


@query("op4_chat_snapshots", CHATS)
def op4(spark, d):
    return format_chats(read_table(spark, d, "conversations"))


@query("op5_cgk_leaks")
def op5(spark, d):
    return find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS s FROM w),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
least AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""


@query("op6_jaccard_components", JACCARD)
def op6(spark, d):
    return jaccard_components(read_table(spark, d, "documents"))


@query("op7_language_id")
def op7(spark, d):
    return predict_languages(read_table(spark, d, "documents"))


LINES = r"""
WITH cut AS (SELECT doc_id, text, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS k, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, k, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT DISTINCT doc_id, k, ls FROM cut)),
w AS (SELECT line, min((doc_id IS NOT NULL, coalesce(doc_id, 0), k, i)) AS place,
             any_value(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS ws FROM l GROUP BY line),
sets AS (SELECT line, place, CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) END AS s FROM w WHERE len(ws) > 0),
tokens AS (SELECT line, place, len(s) AS n, unnest(s) AS t FROM sets),
gone AS (SELECT DISTINCT line FROM (SELECT a.line, b.line AS earlier FROM tokens a JOIN tokens b ON a.t = b.t AND b.place < a.place
         GROUP BY a.line, b.line, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*)))),
kept AS (SELECT l.doc_id, l.k, l.i, l.line FROM l LEFT JOIN sets ON l.line = sets.line LEFT JOIN gone ON l.line = gone.line
         WHERE sets.line IS NULL OR (gone.line IS NULL AND sets.place = (l.doc_id IS NOT NULL, coalesce(l.doc_id, 0), l.k, l.i))),
texts AS (SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM kept GROUP BY doc_id, k)
SELECT c.doc_id, CASE WHEN c.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       CAST(coalesce(len(c.ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(c.ls), 0) - coalesce(t.n, 0) AS INTEGER) AS n_removed
FROM cut c LEFT JOIN texts t ON c.doc_id IS NOT DISTINCT FROM t.doc_id AND c.k = t.k
"""


@query("op8_line_dedup", LINES)
def op8(spark, d):
    return dedup_lines(read_table(spark, d, "documents")).select("doc_id", "text", "n_lines", "n_removed")


WINDOWS = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w WHERE len(ws) >= 35),
named AS (SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS k FROM win),
rep AS (SELECT k FROM named GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(35)) AS i FROM named SEMI JOIN rep USING (k)),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query("op9_superkmer_dedup", WINDOWS)
def op9(spark, d):
    return dedup_substrings(read_table(spark, d, "documents")).drop("kept_text")


@query("op10_best_fit_packing")
def op10(spark, d):
    return pack_documents(read_table(spark, d, "documents"), TOKENIZER)


TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH d AS (SELECT doc_id, {TERMS} AS ts FROM documents),
t AS (SELECT doc_id, unnest(ts) AS term, len(ts) AS n FROM d),
size AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS total FROM d),
wanted AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
points AS (SELECT term, doc_id, any_value(n) AS n, count(*) AS tf FROM t WHERE term IN (SELECT term FROM wanted) GROUP BY term, doc_id),
df AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM points, size GROUP BY term),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
           FROM wanted JOIN points USING (term) JOIN df USING (term), size GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query("op11_k2_treap_search", RANKED)
def op11(spark, d):
    return ranked_search(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


# crc32 of an id's decimal text, bit by bit
CRC = """xor(4294967295, list_reduce(list_transform(string_split('~' || CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
  lambda crc, byte: list_reduce([xor(CASE WHEN crc = 126 THEN 4294967295 ELSE crc END, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base, CASE WHEN conv_id % 20 = 0 THEN 0 ELSE {CRC} % 4 END AS h FROM t GROUP BY conv_id),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON c.base = b.conv_id),
r AS (SELECT conv_id, p - h + k AS d, role, text FROM t JOIN k USING (conv_id) WHERE p > h
      UNION ALL SELECT k.conv_id, p, role, text FROM k JOIN t ON t.conv_id = k.base WHERE p <= k.k),
named AS (SELECT conv_id, d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
          md5(string_agg(role || chr(1) || text, chr(2)) OVER (PARTITION BY conv_id ORDER BY d)) AS name FROM r
          UNION ALL SELECT conv_id, 0, 0, '' FROM c),
ends AS (SELECT conv_id, max(d) AS last FROM named GROUP BY conv_id),
node AS (SELECT d, name, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(last) > d AS inner_node,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last = d), '')) AS ends_sha256
         FROM named JOIN ends USING (conv_id) GROUP BY d, name),
below AS (SELECT a.d, a.name, count(*) FILTER (WHERE NOT u.inner_node) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved
          FROM node u JOIN named a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.d, a.name),
up AS (SELECT u.d, u.name, v.conv_id AS parent_conv_id, v.name AS parent FROM node u
       JOIN named a ON a.conv_id = u.conv_id AND a.d = u.d - 1 JOIN node v ON v.d = a.d AND v.name = a.name),
kids AS (SELECT d - 1 AS d, parent AS name, count(*) AS n FROM up GROUP BY d, parent)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, coalesce(n, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM node JOIN below USING (d, name) LEFT JOIN up USING (d, name) LEFT JOIN kids USING (d, name)
"""


@query("op12_centroid_trie", TRIE)
def op12(spark, d):
    return conversation_trie(read_table(spark, d, "conversations"))


@query("op13_rank_bpe")
def op13(spark, d):
    return token_digests(read_table(spark, d, "documents"), TOKENIZER)
