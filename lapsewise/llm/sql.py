"""Numbered operators as DuckDB SQL, written from their contracts, not from the Spark code."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LETTERS_DIGITS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_terms('text', LETTERS)} AS ts FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
full_p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (coalesce(total, 0) + v)::HUGEINT AS p
  FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN total USING (lang, source)
    LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
lang_p AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)::HUGEINT) // (any_value(t) + any_value(v))::HUGEINT AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS t FROM c GROUP BY lang) USING (lang) GROUP BY lang, term),
top AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
  FROM full_p JOIN lang_p USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM top))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text', LETTERS_DIGITS)} AS ts FROM documents),
w AS (SELECT r, unnest(ts) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM w GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, sum(len(ts)) AS l FROM d WHERE len(ts) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, s),
m AS (SELECT r, doc_id, CAST(75 + (25 * len(ts)::HUGEINT * n_docs) // l AS BIGINT) AS m FROM d, s),
items AS (
  SELECT item_id, unnest({_terms('text', LETTERS_DIGITS)}) AS term
  FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)),
q AS (SELECT item_id, term, count(*) AS repeats FROM items GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, r, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (r) WHERE doc_id IS NOT NULL
  GROUP BY item_id, doc_id, r),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _hits(kind: str, pattern: str) -> str:
    """(doc_id, kind, hit, a, b) of every match: a match starts after the gaps and matches before it."""
    return f"""
  SELECT r, doc_id, text, '{kind}' AS kind, hit, CAST(b - length(hit) AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM (
    SELECT r, doc_id, text, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS b FROM (
      SELECT r, doc_id, text, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT r, doc_id, text, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps
        FROM d WHERE regexp_matches(text, '{pattern}'))))"""


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
LOCAL_PHONE = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
# Digits from the right: every second one is doubled and loses 9 beyond 9.
LUHN = f"""list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({DIGITS}), i, 1) AS INTEGER)
  ELSE (2 * CAST(substr(reverse({DIGITS}), i, 1) AS INTEGER)) % 10
    + (2 * CAST(substr(reverse({DIGITS}), i, 1) AS INTEGER)) // 10 END)) % 10 = 0"""
_ACCOUNT = "(substr(replace(hit, ' ', ''), 5) || substr(replace(hit, ' ', ''), 1, 4))"
MOD97 = f"""list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length({_ACCOUNT}) + 1), lambda i:
  CAST(instr('0123456789{UPPER}', substr({_ACCOUNT}, i, 1)) - 1 AS BIGINT))),
  lambda x, y: (x * (CASE WHEN y > 9 THEN 100 ELSE 10 END) + y) % 97) = 1"""
CARD_WORDS = "credit|debit|karte|tarjeta|carte"


def _near(words: str) -> str:
    return f"regexp_matches(around, '(^|[^a-z])({words})([^a-z]|$)')"


OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
plain AS (
  SELECT * FROM ({_hits('email', EMAIL)})
  UNION ALL SELECT * FROM ({_hits('ip', IP)}) WHERE list_max(list_transform(string_split(hit, '.'),
    lambda p: coalesce(TRY_CAST(p AS HUGEINT), 999))) <= 255
  UNION ALL SELECT * FROM ({_hits('card', CARD)}) WHERE length({DIGITS}) BETWEEN 16 AND 19 AND {LUHN}
  UNION ALL SELECT * FROM ({_hits('phone', PHONE)}) WHERE length({DIGITS}) BETWEEN 8 AND 15),
more AS (
  SELECT *, 0.8 AS s, 'iban|account|bank|konto|cuenta|compte' AS words FROM ({_hits('iban', IBAN)}) WHERE {MOD97}
  UNION ALL SELECT *, 0.4, 'ssn|social|security' FROM ({_hits('ssn', SSN)})
  UNION ALL SELECT *, 0.4, 'card|visa|amex|{CARD_WORDS}' FROM ({_hits('short_card', CARD)})
    WHERE length({DIGITS}) BETWEEN 13 AND 15 AND {LUHN}
  UNION ALL SELECT *, 0.4, 'phone|tel|call|fax|mobile' FROM ({_hits('local_phone', LOCAL_PHONE)})),
placed AS (
  SELECT *, translate(substr(text, greatest(a - 40, 0) + 1, least(a, 40)) || ' ' || substr(text, b + 1, 40),
    '{UPPER}', '{LOWER}') AS around FROM more
  WHERE NOT regexp_matches(substr(text, a, CASE WHEN a > 0 THEN 1 ELSE 0 END), '[\\p{{L}}\\p{{N}}]')
    AND NOT regexp_matches(substr(text, b + 1, 1), '[\\p{{L}}\\p{{N}}]')),
added AS (
  SELECT r, doc_id, kind, a, b FROM placed p
  WHERE round(s + CASE WHEN regexp_matches(around, '(^|[^a-z])(' || words || ')([^a-z]|$)') THEN 0.3 ELSE 0 END
    - CASE WHEN {_near('order|invoice|version|isbn|serial|build|part|ticket')} THEN 0.3 ELSE 0 END, 2) >= 0.6
    AND NOT EXISTS (SELECT 1 FROM plain q WHERE q.r = p.r AND q.a < p.b AND q.b > p.a)),
numbered AS (
  SELECT r, kind, a, b, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn', 'short_card', 'local_phone'], kind) AS k
  FROM (SELECT r, kind, a, b FROM plain UNION ALL SELECT r, kind, a, b FROM added)),
joined AS (
  SELECT r, CAST(sum(CAST(k = 1 AS INTEGER)) AS BIGINT) AS n_email, CAST(sum(CAST(k = 2 AS INTEGER)) AS BIGINT) AS n_ip,
    CAST(sum(CAST(k = 3 AS INTEGER)) AS BIGINT) AS n_card, CAST(sum(CAST(k = 4 AS INTEGER)) AS BIGINT) AS n_phone,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) FILTER (WHERE k <= 4) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) AS spans
  FROM numbered GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (r)
"""

SQL = {"op11_divergence": OP11, "op12_pii": OP12, "op13_lexical": OP13}
