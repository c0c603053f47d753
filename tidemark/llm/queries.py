"""One query per operator, over its whole table with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidemark.llm import decontaminate as decon
from tidemark.llm import conversation_repair, exact_dedup, html_extract, language_model, line_quality, mixing, near_dedup, spelling, suffix_dedup, token_files, toxicity
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.registry import ORACLES, QUERIES, query
from tidemark.session import written

__all__ = ["ORACLES", "QUERIES"]

QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT k, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_loud,
         length(text) - length(replace(text, '|', '')) AS n_bars
  FROM d
), win AS (
  SELECT k, i, array_to_string(words[i:i+7], ' ') AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 7)
), rep AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT k, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
  FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM rep) GROUP BY k
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words, n_loud, n_bars, len(lines) AS n_lines,
         len(list_filter(words, lambda x: list_contains([STOPS], lower(x)))) AS n_stop
  FROM w LEFT JOIN cov USING (k)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 14.0 * n_words
       AND n_symbols <= 0.25 * n_words AND n_loud <= 0.30 * n_words AND n_bars <= 0.25 * n_words
       AND n_dup_lines <= 0.50 * n_lines AND (n_words < 50 OR n_stop >= 0.01 * n_words) AS kept
FROM b
"""


def _quality_sql() -> str:
    from tidemark.llm.quality_rules import STOP_WORDS

    return QUALITY_SQL.replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS))


@query("op1_quality_rules", _quality_sql())
def op1_quality_rules(t):
    """Measures and verdict of every document."""
    return quality_rules(t.documents.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
), i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark
), iw AS (
  SELECT DISTINCT item, n, array_to_string(words[s:s+n-1], ' ') AS g
  FROM (SELECT item, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s
        FROM i WHERE len(words) > 0)
), dw AS (
  SELECT k, n, s, array_to_string(words[s:s+n-1], ' ') AS g
  FROM (SELECT k, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(words) >= n)
), hit AS (
  SELECT k, n, s, item FROM dw JOIN iw USING (g, n)
), hw AS (
  SELECT k, count(DISTINCT w) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS w FROM (SELECT DISTINCT k, n, s FROM hit)) GROUP BY k
), hi AS (
  SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY k
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (k) LEFT JOIN hi USING (k)
"""


@query("op5_decontamination", DECONTAMINATION_SQL)
def op5_decontamination(t):
    """Hits of the benchmark in every document."""
    return decon.contamination(t.documents.select("doc_id", "text"), t.benchmark)


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, xxh AS k,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM (SELECT *, row_number() OVER () AS xxh FROM documents)
), s AS (
  SELECT source, count(*) AS rows, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
         2.0::DOUBLE * source_size AS most FROM s
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(i % 3 + 1)::INT] AS weight FROM o
), l AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), v AS (
  SELECT min_by(level, (most / weight, i)) AS level FROM l WHERE level * weight <= most
), t AS (
  SELECT source, source_size, least(most, coalesce((SELECT level FROM v) * weight, most)) AS target,
         ('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM w
), r AS (
  SELECT d.doc_id, size, source_size, target, u, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST) - 1 AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor(rate * (p + 1) + u) - floor(rate * p + u)) * size)::BIGINT AS taken FROM r
"""


@query("op6_source_mixing", MIXING_SQL)
def op6_source_mixing(t):
    """Words that the mix takes of every document."""
    docs = t.documents.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.copies(written(docs, "sizes"), order=[F.col("doc_id").asc_nulls_last()])
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query("op4_token_files")
def op4_token_files(t):
    """Token files of all documents, read back."""
    import public_tokenizers

    return token_files.token_files(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_near_duplicates")
def op10_near_duplicates(t):
    """Components of near duplicates among all documents."""
    return near_dedup.near_duplicates(t.documents)


@query("op9_line_quality")
def op9_line_quality(t):
    """Quality of every document."""
    return line_quality.line_quality(t.documents, t.labels)


@query("op3_language_model")
def op3_language_model(t):
    """Log probabilities of every document."""
    return language_model.language_model_scores(t.documents)


@query("op2_toxicity")
def op2_toxicity(t):
    """Toxicity of every document."""
    return toxicity.toxicity(t.documents, t.labels)


@query("op8_html_extraction")
def op8_html_extraction(t):
    """Main text of every page."""
    return html_extract.main_text(t.pages)


@query("op7_suffix_dedup")
def op7_suffix_dedup(t):
    """What is left of every document without passages that occur twice."""
    cut = suffix_dedup.remove_repeated(t.documents)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


EXACT_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST, k) = 1 AS kept, sha256(text) AS text_sha256
FROM d WINDOW g AS (PARTITION BY text)
"""


@query("op11_exact_duplicates", EXACT_SQL)
def op11_exact_duplicates(t):
    """The row that stays for the text of every document."""
    return exact_dedup.exact_duplicates(t.documents, keep="largest")


# CRC-32 by its rule: for each byte one xor, and eight shifts (marked -1).
CRC32 = """
list_reduce(
  flatten(list_transform(range(octet_length(encode(TEXT))),
    lambda i: [('0x' || substr(hex(encode(TEXT)), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT)
"""

SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), low AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(CRC, 4294967295) AS h FROM low
), changed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT p.word, count(*) AS n_near, max(b.n) AS most FROM pairs p JOIN words b ON b.word = p.near GROUP BY p.word
), formed AS (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near,
         CASE WHEN most >= 2 * w.n THEN (SELECT min(encode(p.near)) FROM pairs p JOIN words b ON b.word = p.near WHERE p.word = w.word AND b.n = most) END AS form,
         CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), chain AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT c.word, decode(f.form) FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), last AS (
  SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, decode(f.form) AS form, last.root, f.n, f.n_near, f.form_n FROM formed f JOIN last ON last.word = f.word
""".replace("CRC", CRC32.replace("TEXT", "(id || ':' || run)"))


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(t):
    """Variants among the words of all documents, typing errors made by rule included."""
    return spelling.spelling_variants(spelling.word_counts(t.documents, change=spelling.slip))


REPAIR_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hurt AS (
  SELECT *, xor(CRC, 4294967295) % 20 AS m FROM src
), dmg AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
         CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE m WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hurt
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy) AS p FROM dmg
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
         lag(role) OVER (PARTITION BY conv_id ORDER BY p) AS prev FROM placed
), rows_ AS (
  SELECT conv_id, turn, role, text, p, substr(role, 1, 1) AS i, substr(prev, 1, 1) || substr(role, 1, 1) AS two,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS fault FROM seen
), ins(a, z, c, e, lines) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []),
         (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']),
         (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:'])
), edits(a, z, e, i, c, said) AS (
  VALUES (0, 0, 'D', NULL, 4, NULL), (1, 1, 'D', NULL, 4, NULL), (2, 2, 'D', NULL, 4, NULL), (3, 3, 'D', NULL, 4, NULL),
         (0, 1, 'K', 's', 0, NULL), (0, 2, 'K', 'u', 0, NULL), (1, 2, 'K', 'u', 0, NULL), (3, 2, 'K', 'u', 0, NULL), (2, 3, 'K', 'a', 0, NULL),
         (0, 2, 'R', NULL, 3, 'user'), (1, 2, 'R', NULL, 3, 'user'), (3, 2, 'R', NULL, 3, 'user'), (2, 3, 'R', NULL, 3, 'assistant')
), moves AS (
  SELECT ins.a, edits.z, edits.e AS edit, edits.i, ins.c + edits.c AS c, ins.e || edits.e AS e, said, lines FROM ins JOIN edits ON ins.z = edits.a
), dp AS (
  SELECT conv_id, 0::BIGINT AS p, 0 AS st, {'c': 0::BIGINT, 'e': '', 'lines': []::VARCHAR[]} AS best FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT r.conv_id, r.p, m.z,
         min({'c': (dp.best.c + m.c + CASE WHEN m.edit <> 'D' AND r.fault = 't' THEN 3 ELSE 0 END)::BIGINT, 'e': dp.best.e || m.e,
              'lines': list_concat(list_concat(dp.best.lines, m.lines),
                                   CASE m.edit WHEN 'D' THEN []::VARCHAR[] ELSE [coalesce(m.said, r.role) || ':' || r.text] END)})
  FROM dp JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.p = dp.p + 1
  JOIN moves m ON m.a = dp.st AND (m.i IS NULL OR m.i = r.i) AND (m.edit = 'D' OR r.fault NOT IN ('b', 'd'))
  GROUP BY r.conv_id, r.p, m.z
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (p > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id
), done AS (
  SELECT dp.conv_id, min({'c': best.c + ins.c, 'e': best.e || ins.e, 'lines': list_concat(best.lines, ins.lines)}) AS best
  FROM dp LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id
  JOIN ins ON ins.a = dp.st AND (ins.z = 3 OR ins.a = 0 AND ins.z = 0)
  WHERE dp.p = coalesce(f.n, 0) GROUP BY dp.conv_id
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.e AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM done d LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM d.conv_id
""".replace("CRC", CRC32.replace("TEXT", "k"))


@query("op13_conversation_repair", REPAIR_SQL)
def op13_conversation_repair(t):
    """Cheapest repair of every conversation after damage by rule."""
    return conversation_repair.repair_report(conversation_repair.damaged(t.conversations), t.conversations)
