"""SQL (DuckDB) of the training-data operators that SQL can express.

Packing, tokenizers, the language model and stored media are tested against plain loops instead (``tests/llm``).
"""

from __future__ import annotations

from tidewright.llm import licenses, quality

OP1 = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    regexp_replace(coalesce(text, ''), '([<\\[])(\\\\*)(\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>|s>|/s>|INST\\]|/INST\\])', '\\1\\\\\\2\\3', 'g') AS body
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(body) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_WORD = "[^\\x20\\x09-\\x0D]+"


def _fails(x: str) -> str:
    """The rules of a line that it fails by itself."""
    visible = f"length(regexp_replace({x}, '[\\x20\\x09-\\x0D]+', '', 'g'))"
    plain = f"length(regexp_replace({x}, '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g'))"
    shape = f"{plain} * 2 < {visible} OR len(regexp_extract_all({x}, '{quality.SYMBOLS}')) * 5 > {visible}"
    navigation = f"len(regexp_extract_all({x}, '{quality.SEPARATORS}')) >= 3 OR regexp_matches(lower({x}), '^\\W*({'|'.join(quality.LABELS)})\\W*$')"
    phrases = f"len(regexp_extract_all(lower({x}), '{'|'.join(quality.BOILERPLATE)}'))"
    return f"({shape} OR {navigation} OR ({phrases} > 0 AND {phrases} * {quality.PHRASE_WORDS} >= len(regexp_extract_all({x}, '{_WORD}'))))"


def _marked(x: str) -> str:
    return f"regexp_matches({x}, '{quality.MARKS}')"


def _lacks(x: str, i: str) -> str:
    """Whether line i of ``filled`` lacks a mark where one is expected."""
    words = f"len(regexp_extract_all({x}, '{_WORD}'))"
    expected = f"coalesce({_marked(f'filled[{i} - 1]')}, true) AND coalesce({_marked(f'filled[{i} + 1]')}, true) AND len(filled) > 1"
    return f"({words} >= 4 AND NOT {_marked(x)} AND NOT regexp_matches({x}, '{quality.UNMARKED}') AND ({words} > {quality.VERSE_WORDS} OR ({expected})))"


OP7 = f"""
WITH read AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS filled
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS w FROM read, unnest(range(1, len(words) - 6)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(8)) AS v(k) GROUP BY doc_id
), figures AS (
  SELECT read.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{quality.SYMBOLS}'))::BIGINT AS n_symbols,
    (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(filled, lambda x, i: {_fails('x')} OR {_lacks('x', 'i')}), lambda x: length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')))), 0)::BIGINT AS lost_chars
  FROM read LEFT JOIN covered ON read.doc_id = covered.doc_id
), judged AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars,
  NOT base_failed AND 100 * lost_chars <= {quality.MOST_LOST_PERCENT} * word_chars AS kept
FROM judged
"""


def _license_sql() -> str:
    tests = licenses.templates()
    texts = ", ".join(f"({t.place}, '{t.name}', [{', '.join(repr(b) for b in t.bigrams)}], {t.n_words}, '{t.opening}')" for t in tests)
    return f"""
WITH templates(place, name, pairs, n_words, opening) AS (VALUES {texts}),
units AS (
  SELECT doc_id, 'whole' AS kind, 0 AS place, coalesce(text, '') AS t FROM documents
  UNION ALL
  SELECT doc_id, 'line', i, string_split(coalesce(text, ''), chr(10))[i] FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)
), cut AS (
  SELECT doc_id, kind, place, list_filter(string_split_regex(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM units
), paired AS (
  SELECT doc_id, kind, place, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM cut
), scored AS (
  SELECT doc_id, kind, paired.place, round(2.0 * len(list_intersect(paired.pairs, templates.pairs)) / (len(paired.pairs) + len(templates.pairs)), 6) AS dice, -templates.place AS rank, name
  FROM paired, templates
), best AS (
  SELECT doc_id, kind, place, max(struct_pack(dice := dice, rank := rank, name := name)) AS m FROM scored WHERE dice >= {licenses.LEAST_DICE} GROUP BY ALL
), lines AS (
  SELECT doc_id, count(*) AS n, max(m) AS m FROM best WHERE kind = 'line' GROUP BY doc_id
), full_lines AS (
  SELECT doc_id, place, w, array_to_string(w, ' ') AS t, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY place) - len(w) AS words_before
  FROM cut WHERE kind = 'line' AND len(w) > 0
), starts AS (
  SELECT l.doc_id, l.place, l.words_before, t.place AS template, t.name, t.pairs, t.n_words
  FROM full_lines AS l JOIN templates AS t ON regexp_matches(l.t, t.opening)
), blocks AS (
  SELECT s.doc_id, s.place, s.template, s.name, s.pairs AS wanted, flatten(list(l.w ORDER BY l.place)) AS w
  FROM starts AS s JOIN full_lines AS l ON l.doc_id = s.doc_id AND l.place >= s.place AND l.words_before - s.words_before < s.n_words
  GROUP BY s.doc_id, s.place, s.template, s.name, s.pairs
), block_pairs AS (
  SELECT *, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM blocks
), block_dice AS (
  SELECT *, round(2.0 * len(list_intersect(pairs, wanted)) / (len(pairs) + len(wanted)), 6) AS dice FROM block_pairs
), best_blocks AS (
  SELECT doc_id, max(struct_pack(dice := dice, rank := -template, name := name)) AS m FROM block_dice WHERE dice >= {licenses.LEAST_DICE} GROUP BY doc_id
)
SELECT documents.doc_id, whole.m.name AS whole_license, coalesce(lines.n, 0)::BIGINT AS n_license_lines, lines.m.name AS license, lines.m.dice AS dice,
  best_blocks.m.name AS block_license, best_blocks.m.dice AS block_dice
FROM documents LEFT JOIN lines ON documents.doc_id = lines.doc_id
LEFT JOIN (SELECT * FROM best WHERE kind = 'whole') AS whole ON documents.doc_id = whole.doc_id
LEFT JOIN best_blocks ON documents.doc_id = best_blocks.doc_id
"""


OP9 = """
WITH RECURSIVE read AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i+4], ' ')) AS s FROM read, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS u(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes AS m ON m.doc_id = a.doc_id JOIN sizes AS n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a
), least_of AS (
  SELECT a AS doc_id, min(b) AS m FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM documents AS d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least_of ON least_of.doc_id = d.doc_id
"""



def _codes_sql(rounds: int = 4) -> str:
    """Lloyd's rounds one after the other. Doubles hold all integers here exactly."""
    ctes = [
        """kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "parted AS MATERIALIZED (SELECT n, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, unnest(range(4)) AS u(p))",
        "book0 AS MATERIALIZED (SELECT p, n - 1 AS k, x FROM parted WHERE n <= 256)",
    ]
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS MATERIALIZED (
  SELECT n, a.p, any_value(a.x) AS x, min(struct_pack(d := list_dot_product(a.x, a.x) - 2 * list_dot_product(a.x, b.x) + list_dot_product(b.x, b.x), k := k)) AS m
  FROM parted AS a JOIN book{r} AS b ON a.p = b.p GROUP BY n, a.p
)""")
        if r < rounds:
            ctes.append(f"""mean{r} AS (
  SELECT p, k, list(y ORDER BY j) AS x FROM (
    SELECT p, m.k AS k, j, floor(sum(x[j]) / count(*)) AS y FROM near{r}, unnest(range(1, len(x) + 1)) AS u(j) GROUP BY p, m.k, j
  ) GROUP BY p, k
)""")
            ctes.append(f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(mean{r}.x, b.x) AS x FROM book{r} AS b LEFT JOIN mean{r} ON b.p = mean{r}.p AND b.k = mean{r}.k)")
    return f"""
WITH {", ".join(ctes)}, coded AS (
  SELECT n, string_agg(printf('%02x', m.k), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{rounds} GROUP BY n
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT), ','), ',' ORDER BY p, k)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept ON coded.n = kept.n
"""


OP12 = f"""
WITH read AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+49], ' ') AS x FROM read, unnest(range(1, len(w) - 48)) AS u(i)
), copied AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS least FROM windows) WHERE least < doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS places FROM copied, unnest(range(50)) AS v(k) GROUP BY doc_id
)
SELECT read.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
  sha256(coalesce(CASE WHEN places IS NULL THEN array_to_string(w, ' ')
    ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]), ' ') END, '')) AS kept_sha256
FROM read LEFT JOIN gone ON read.doc_id = gone.doc_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP13 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents
), totals AS (
  SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM docs WHERE len(t) > 0
), asked AS (
  SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), postings AS (
  SELECT r, doc_id, n_terms, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(t)::BIGINT AS n_terms, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, n_terms, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, n
), scored AS (
  SELECT item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n_terms * n) // l))))::BIGINT AS score
  FROM asked JOIN postings ON asked.term = postings.term JOIN weighed ON weighed.term = asked.term, totals GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""

ORACLE_SQL = {"op1_chat_format": OP1, "op7_quality": OP7, "op8_licenses": _license_sql(), "op9_near_dedup": OP9, "op12_relative_lz": OP12, "op13_lexical_search": OP13, "op11_vector_codes": _codes_sql()}
