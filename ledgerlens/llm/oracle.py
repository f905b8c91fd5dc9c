"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .licences import Params as LicenceParams
from .quality_rules import BINS, COMMON_WORDS, Rules
from .spotsigs import ANCHORS, CHAIN

WORD = r"[^\x20\x09-\x0D]+"


def _quality_sql(rules: Rules = Rules()) -> str:
    listed = ", ".join(f"({lang!r}, {w!r}, {i})" for lang, ws in COMMON_WORDS.items() for i, w in enumerate(ws))
    classes = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "stop": r".,;:!?''\"()-"}
    counts = ", ".join(f"length(regexp_replace(body, '[^{c}]+', '', 'g')) AS c{i}" for i, c in enumerate(classes.values()))
    langs = ", ".join(f"{k!r}" for k in COMMON_WORDS)
    jsd = "CASE WHEN p > 0 THEN p * log2(2.0 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2.0 * q / (p + q)) ELSE 0 END"
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
         CASE WHEN lang IN ({langs}) THEN lang ELSE '*' END AS lang,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '{WORD}') GROUP BY r),
wins AS (
  SELECT r, i, len(w) AS n, array_to_string(w[i:i + {rules.window - 1}], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {rules.window - 2})) AS i FROM base WHERE len(w) >= {rules.window})),
rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + {rules.window})) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM wins) WHERE k > 1)
  GROUP BY r),
chars AS (
  SELECT r, lang, len(w) AS n, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS chars, {counts} FROM base),
char_h AS (
  SELECT r, lang, chars, unnest([0, 1, 2, 3, 4]) AS slot,
         unnest([c0, c1, c2, c3, chars - c0 - c1 - c2 - c3]) AS k, k / chars AS p, k * {BINS} // chars AS bin
  FROM chars WHERE chars >= {max(rules.min_chars, 1)}),
char_m AS (
  SELECT lang, slot, quantile_disc(bin, 0.5) AS m FROM char_h WHERE lang <> '*' GROUP BY ALL
  UNION ALL SELECT '*', slot, quantile_disc(bin, 0.5) FROM char_h GROUP BY ALL),
char_ref AS (SELECT lang, slot, m / sum(m) OVER (PARTITION BY lang) AS q FROM char_m),
char_d AS (
  SELECT r, sqrt(greatest(sum({jsd}) / 2, 0)) AS d FROM char_h JOIN char_ref USING (lang, slot) GROUP BY r),
listed(lang, w, slot) AS (VALUES {listed}),
tokens AS (SELECT r, lang, unnest(w) AS w FROM base WHERE lang <> '*' AND len(w) >= {max(rules.min_words, 1)}),
hits AS (SELECT r, slot, count(*) AS k FROM tokens JOIN listed USING (lang, w) GROUP BY ALL),
word_k AS (
  SELECT c.r, c.lang, l.slot, c.n, coalesce(h.k, 0) AS k
  FROM chars c JOIN listed l ON c.lang = l.lang LEFT JOIN hits h ON h.r = c.r AND h.slot = l.slot
  WHERE c.n >= {max(rules.min_words, 1)}),
word_h AS (
  SELECT r, lang, slot, k / n AS p, k * {BINS} // n AS bin FROM word_k
  UNION ALL SELECT r, lang, 12, (n - sum(k)) / n, ((n - sum(k)) * {BINS} // n)::BIGINT FROM word_k GROUP BY r, lang, n),
word_m AS (SELECT lang, slot, quantile_disc(bin, 0.5) AS m FROM word_h GROUP BY ALL),
word_ref AS (SELECT lang, slot, m / sum(m) OVER (PARTITION BY lang) AS q FROM word_m),
word_d AS (
  SELECT r, sqrt(greatest(sum({jsd}) / 2, 0)) AS d FROM word_h JOIN word_ref USING (lang, slot) GROUP BY r),
judged AS (
  SELECT b.doc_id, len(b.w) AS n_words, c.chars AS word_chars,
         length(regexp_replace(b.body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(p.n_repeat_words, 0) AS n_repeat_words,
         coalesce(cd.d, 0) <= {rules.max_char_distance} AND coalesce(wd.d, 0) <= {rules.max_word_distance} AS near
  FROM base b JOIN chars c USING (r) LEFT JOIN lines l USING (r) LEFT JOIN rep p USING (r)
  LEFT JOIN char_d cd USING (r) LEFT JOIN word_d wd USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
       NOT (n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words) AND near AS kept
FROM judged"""


ESCAPED = r"replace({0}, '\', '\\'), '(<s>|</s>|\[/?INST\]|<\|(role|text|end)\|>)', '+\1', 'g'"
CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 23 + length(regexp_replace({ESCAPED.format("role")})) END
            + length(regexp_replace({ESCAPED.format("text")})) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""



def _licence_sql(p: LicenceParams = LicenceParams()) -> str:
    listed = ", ".join(f"({k}, '{name}', $${text}$$)" for k, (name, text) in enumerate(p.listed()))
    cut = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return rf"""
WITH files AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
         CASE WHEN doc_id % 8 <> 0 THEN concat(source, '/', lang, '/', doc_id % 7, '/', doc_id, '.txt')
              WHEN doc_id % 3 = 0 THEN concat(source, '/LICENSE') WHEN doc_id % 3 = 1 THEN concat(source, '/', lang, '/LICENSE')
              ELSE concat(source, '/', lang, '/', doc_id % 7, '/COPYING.txt') END AS path,
         doc_id % 8 = 0 AS is_file
  FROM documents),
templates(k, license, t) AS (VALUES {listed}),
tpl AS (SELECT k, license, w, count(*) AS n FROM (SELECT k, license, unnest({cut.format("t")}) AS w FROM templates) GROUP BY ALL),
words AS (SELECT DISTINCT r, unnest({cut.format("body")}) AS w FROM files),
df AS (SELECT w, count(*) AS df FROM words GROUP BY w),
total AS (SELECT count(*) AS n FROM files),
told AS (SELECT w, 1 + ln((SELECT count(*) FROM templates) / count(*)) AS told FROM tpl GROUP BY w),
tv AS (SELECT k, license, tpl.w, tpl.n * (ln((1 + total.n) / (1 + coalesce(df, 0))) + 1) * told AS v FROM tpl JOIN told USING (w) LEFT JOIN df USING (w), total),
tnorm AS (SELECT k, sqrt(sum(v * v)) AS norm FROM tv GROUP BY k),
hit AS (SELECT DISTINCT r FROM words WHERE w IN (SELECT w FROM tpl)),
lines AS (
  SELECT r, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]')) AS ls FROM files JOIN hit USING (r)),
segs AS (
  SELECT r, row_number() OVER () AS i, {cut.format("t")} AS ws FROM (
    SELECT r, unnest(regexp_split_to_array(l, '[.;!?]+\s+')) AS t FROM (SELECT r, unnest(ls) AS l FROM lines)
    UNION ALL SELECT r, ls[j] || ' ' || ls[j + 1] FROM (SELECT r, ls, unnest(range(1, len(ls))) AS j FROM lines)
    UNION ALL SELECT r, body FROM files WHERE is_file)),
sw AS (SELECT r, i, w, count(*) AS n FROM (SELECT r, i, unnest(ws) AS w FROM segs) GROUP BY ALL),
sv AS (
  SELECT r, i, w, s.n * (ln((1 + t.n) / (1 + coalesce(df, 0))) + 1) * coalesce(told, 1 + ln((SELECT count(*) FROM templates)) / 2) AS v
  FROM sw s LEFT JOIN df USING (w) LEFT JOIN told USING (w), total t),
snorm AS (SELECT r, i, sqrt(sum(v * v)) AS norm FROM sv GROUP BY ALL),
dots AS (SELECT r, i, k, license, sum(sv.v * tv.v) AS d FROM sv JOIN tv USING (w) GROUP BY ALL),
scored AS (SELECT r, i, k, license, round(d / (s.norm * t.norm), 6) AS score FROM dots JOIN snorm s USING (r, i) JOIN tnorm t USING (k)),
nearest AS (SELECT r, i, k, license, score FROM scored WHERE score >= {p.threshold} QUALIFY row_number() OVER (PARTITION BY r, i ORDER BY score DESC, k) = 1),
clear AS (
  SELECT n.r, n.i, n.k, n.license, n.score FROM nearest n LEFT JOIN scored o ON o.r = n.r AND o.i = n.i AND o.license <> n.license
  GROUP BY ALL HAVING n.score >= round(coalesce(max(o.score), 0) + {p.margin}, 6)),
own AS (
  SELECT r, license, score FROM clear
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY license <> 'proprietary' DESC, score DESC, k) = 1),
found AS (
  SELECT r, doc_id, path, is_file, regexp_replace(path, '/?[^/]*$', '') AS dir, license, score FROM files LEFT JOIN own USING (r)),
owners AS (
  SELECT dir AS owner, license AS inherited FROM found WHERE is_file AND license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
near AS (
  SELECT dir, owner, inherited FROM (SELECT DISTINCT dir FROM found) JOIN owners ON dir = owner OR owner = '' OR starts_with(dir, owner || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(owner) DESC) = 1)
SELECT doc_id, path, license AS declared, score, inherited, owner AS inherited_from, coalesce(license, inherited) AS license
FROM found LEFT JOIN near USING (dir)"""


def _spotsigs_sql(chain: int = CHAIN) -> str:
    anchors = ", ".join(f"'{w}'" for w in sorted({w for ws in ANCHORS.values() for w in ws}))
    links = ", ".join(f"content[i - r + {j + 1}]" for j in range(chain))
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents),
edits AS (SELECT *, substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited FROM docs),
kinds AS (
  SELECT doc_id, 's' AS kind, text AS t FROM edits UNION ALL SELECT doc_id, 'e', edited FROM edits
  UNION ALL SELECT doc_id, 'n', next_text FROM edits),
tokens AS (SELECT doc_id, kind, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}\p{{M}}]+'), lambda x: x <> '') AS ws FROM kinds),
split AS (SELECT *, list_filter(ws, lambda x: x NOT IN ({anchors})) AS content FROM tokens),
placed AS (SELECT doc_id, kind, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM split),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY i) AS r FROM placed WHERE w IN ({anchors})),
sigs AS (
  SELECT doc_id, kind, list_sort(list(DISTINCT concat_ws(' ', w, {links}))) AS s
  FROM ranked JOIN split USING (doc_id, kind) WHERE i - r < len(content) GROUP BY ALL),
sets AS (SELECT t.doc_id, t.kind, coalesce(s, ['= ' || array_to_string(ws, ' ')]) AS s FROM tokens t LEFT JOIN sigs USING (doc_id, kind)),
wide AS (
  SELECT doc_id, any_value(s) FILTER (kind = 's') AS a, any_value(s) FILTER (kind = 'e') AS b, any_value(s) FILTER (kind = 'n') AS c
  FROM sets GROUP BY doc_id)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
       md5(array_to_string(a, chr(10))) AS fingerprint, md5(array_to_string(b, chr(10))) AS edited_fingerprint,
       len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) AS near_edited,
       len(list_intersect(a, c)) / (len(a) + len(c) - len(list_intersect(a, c))) AS near_next
FROM edits JOIN wide USING (doc_id)"""


SQL = {"op10_spotsigs": _spotsigs_sql(), "op6_licences": _licence_sql(), "op1_chat_template": CHAT_SQL, "op4_quality_rules": _quality_sql()}
