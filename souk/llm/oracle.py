"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from souk.llm import licenses

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = licenses.UPPER, licenses.LOWER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses() -> str:
    """All blocks of all texts against all templates, without any filter."""
    forms = licenses._forms(licenses.TEMPLATES, licenses.CONTAINMENT)
    rows = ", ".join("({}, {}, {}, {}, [{}])".format(_text(f.label), f.size, f.need, len(f.words), ", ".join(map(_text, sorted(f.words)))) for f in forms)
    places = " UNION ALL ".join(
        "SELECT r, i, {} AS label FROM (SELECT r, words, unnest(range(0, len(words))) AS i FROM w) WHERE {}".format(
            _text(label), " AND ".join(f"words[i + {k + 1}] = {_text(p)}" for k, p in enumerate(phrase.split(" "))))
        for phrase, label in licenses.PHRASES)
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{licenses.WORD}'), []) AS words
  FROM documents),
forms(label, size, need, n_of, wanted) AS (VALUES {rows}),
sizes AS (SELECT DISTINCT size FROM forms),
blocks AS (
  SELECT r, size, list_distinct(words[b * size + 1 : b * size + 2 * size]) AS held
  FROM (SELECT r, words, size, unnest(range(0, (len(words) + size - 1) // size)) AS b FROM w CROSS JOIN sizes)),
shared AS (
  SELECT r, label, need, n_of, len(list_intersect(held, wanted)) AS n FROM blocks JOIN forms USING (size)),
own AS (SELECT r, label, n / n_of AS share FROM shared WHERE n >= need),
places AS ({places}),
p AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT r, label FROM own UNION SELECT r, label FROM places) GROUP BY r),
s AS (SELECT r, max(share) AS share FROM own GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN p USING (r) LEFT JOIN l USING (r) LEFT JOIN s USING (r)"""


# crc32 as SQL: a table of 256 remainders, folded over the bytes
_CRC = """
crc_table AS (
  SELECT list(list_reduce([b] || range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256)) AS b))"""


SPELLING = f"""
WITH {_CRC},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(run, '{_UPPER}', '{_LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)),
counted AS (SELECT d, run, count(*) AS n FROM runs GROUP BY d, run),
bytes AS (
  SELECT d, run, n, hex(encode(d || ':' || run)) AS x FROM counted),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           [4294967295] || list_transform(range(0, len(x) // 2), lambda i: CAST(('0x' || x[2 * i + 1 : 2 * i + 2]) AS BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc_table),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 : length(run)] ELSE run END AS word, n FROM hashed),
vocab AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, i, word[1 : i - 1] || word[i + 1 : length(word)] AS rest
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM vocab a JOIN cuts b ON a.word = b.rest
  UNION SELECT b.word, a.word FROM vocab a JOIN cuts b ON a.word = b.rest),
ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS k
  FROM near JOIN vocab o ON o.word = other),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
         CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN ranked r ON r.word = v.word AND r.k = 1),
steps AS (
  SELECT word, coalesce(f4.form, f3.form, f2.form, f1.form, f0.form, f0.word) AS root
  FROM forms f0
  LEFT JOIN (SELECT word AS w1, form FROM forms) f1 ON w1 = f0.form
  LEFT JOIN (SELECT word AS w2, form FROM forms) f2 ON w2 = f1.form
  LEFT JOIN (SELECT word AS w3, form FROM forms) f3 ON w3 = f2.form
  LEFT JOIN (SELECT word AS w4, form FROM forms) f4 ON w4 = f3.form)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN steps USING (word)"""

RANKED_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}'), []) AS terms
  FROM documents),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
items AS (
  SELECT row_number() OVER () AS q, item_id,
         list_distinct(coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}'), [])) AS terms
  FROM benchmark),
asked AS (SELECT q, item_id, unnest(terms) AS term FROM items),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN d USING (r), total
  GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLE: dict[str, str] = {
    "op11_licenses": _licenses(),
    "op12_spelling": SPELLING,
    "op13_ranked_search": RANKED_SEARCH,
}
