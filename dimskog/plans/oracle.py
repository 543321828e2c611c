"""The SQL each core query is compared with, written for DuckDB from the semantics.

Queries without an entry are folds or regular expressions with lookaround that RE2 lacks; the tests
hold those against plain Python on small fixtures.
"""

from __future__ import annotations

from dimskog.operators.backend import MOCK_KEYWORDS, REGISTRY
from dimskog.operators.chunking import ABBREVIATIONS
from dimskog.operators.gazetteer import CATEGORY_LABELS, GENERIC, SUFFIXES
from dimskog.operators.tagging import CATEGORIES, MASK, MODEL
from dimskog.operators.training import HIGH_RISK
from dimskog.plans.words import NAMED, NOTE_WORDS, UNSURE
from dimskog.schema import DIRECT, FALLBACK, GROUND_TRUTH, PLACEHOLDERS, PROTECTED, SOURCES, VERBATIM, sql_list


def case_map(x: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^[\s\p{{Z}}]+', ''), '[\s\p{{Z}}]+$', '')"


def norm(x: str) -> str:
    return rf"regexp_replace({strip(f"replace(lower(coalesce({x}, '')), 'ß', 'ss')")}, '[\s\p{{Z}}]+', ' ', 'g')"


DIRECT_LIST, PROTECTED_LIST, GT_LIST = sql_list(DIRECT), sql_list(PROTECTED), sql_list(GROUND_TRUTH)

ENTITIES = """
    SELECT run_label, note, audit_id AS seq, original AS txt, label, CAST(start_pos AS BIGINT) AS s, CAST(end_pos AS BIGINT) AS e, source, generalized_to AS g, risk FROM audit
"""
TEXTS = "SELECT doc_id AS note, arg_max(text, (coalesce(received_at, TIMESTAMP '1970-01-01'), note_id)) AS text FROM notes WHERE text IS NOT NULL GROUP BY doc_id"


def matches(table: str, key: str, text: str, pattern: str) -> str:
    """(key, i, s, e, txt) of all matches: the gaps of a split and the matches alternate."""
    return f"""
        SELECT {key}, i, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
               list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e, m[i] AS txt
        FROM (SELECT {key}, g, m, unnest(generate_series(1, len(m))) AS i
              FROM (SELECT {key}, string_split_regex({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}') AS m FROM {table} WHERE {text} IS NOT NULL))
    """


def replacement(txt: str, label: str, g: str, no_generalize: bool = False) -> str:
    known = sql_list(PLACEHOLDERS)
    t = f"coalesce({txt}, '')"
    out = f"CASE WHEN {label} IN {sql_list(VERBATIM)} THEN {t} "
    if not no_generalize:
        out += (
            f"WHEN coalesce({g}, '') <> '' AND {label} IN {known} AND {label} NOT IN {DIRECT_LIST} AND NOT contains(lower({strip(g)}), lower({strip(t)})) THEN {g} "
            f"WHEN {label} = 'age' AND {age(t)} IS NOT NULL THEN {age(t)} "
        )
    return out + f"ELSE {case_map(label, PLACEHOLDERS, repr(FALLBACK))} END"


def age(t: str) -> str:
    a = f"TRY_CAST(regexp_extract({t}, '[0-9]{{1,3}}') AS INTEGER)"
    return f"CASE WHEN {a} >= 90 THEN '90 år eller äldre' WHEN {a} > 0 THEN (({a} // 10) * 10)::VARCHAR || '-' || (({a} // 10) * 10 + 10)::VARCHAR || ' år' END"


PLAN_OF = f"""
    cuts AS (SELECT DISTINCT run_label, note, lo FROM (SELECT run_label, note, s AS lo FROM ents UNION ALL SELECT run_label, note, e FROM ents)),
    atoms AS (SELECT run_label, note, lo, lead(lo) OVER (PARTITION BY run_label, note ORDER BY lo) AS hi FROM cuts),
    cover AS (
        SELECT a.lo, a.hi, x.*, row_number() OVER (PARTITION BY x.run_label, x.note, a.lo ORDER BY coalesce(label IN {DIRECT_LIST}, false) DESC,
               (coalesce(source IN {GT_LIST}, false) AND coalesce(label IN {PROTECTED_LIST}, false)) DESC, e - s DESC, seq) AS r
        FROM atoms a JOIN ents x ON x.run_label = a.run_label AND x.note = a.note AND x.s <= a.lo AND x.e >= a.hi WHERE a.hi IS NOT NULL),
    owned AS (SELECT *, CASE WHEN lag(hi) OVER (PARTITION BY run_label, note, seq ORDER BY lo) = lo THEN 0 ELSE 1 END AS fresh, sum(hi - lo) OVER (PARTITION BY run_label, note, seq) AS mine FROM cover WHERE r = 1),
    isl AS (SELECT *, sum(fresh) OVER (PARTITION BY run_label, note, seq ORDER BY lo) AS island FROM owned),
    plan AS (
        SELECT run_label, note, seq, label, source, min(lo) AS start_pos, max(hi) AS end_pos, mine = e - s AS whole, CASE WHEN mine = e - s THEN g END AS generalized,
               CASE WHEN mine = e - s THEN txt ELSE substring(txt, CAST(min(lo) - s + 1 AS BIGINT), CAST(max(hi) - min(lo) AS BIGINT)) END AS txt
        FROM isl GROUP BY run_label, note, seq, label, source, island, mine, e, s, g, txt)
"""
PLAN = f"ents AS ({ENTITIES}), {PLAN_OF}"

SPLICE_OF = f"""
    reps AS (SELECT run_label, note, start_pos, end_pos, {replacement('txt', 'label', 'generalized')} AS rep FROM plan),
    seqd AS (SELECT *, lag(end_pos) OVER w AS pe, lag(rep) OVER w AS pr FROM reps WINDOW w AS (PARTITION BY run_label, note ORDER BY start_pos)),
    parts AS (
        SELECT r.run_label, r.note, r.text, max(end_pos) AS last,
               string_agg(substring(r.text, CAST(coalesce(pe, 0) + 1 AS BIGINT), CAST(start_pos - coalesce(pe, 0) AS BIGINT)) || CASE WHEN coalesce(pe = start_pos AND pr = rep, false) THEN '' ELSE rep END, '' ORDER BY start_pos) AS head
        FROM runs r JOIN seqd q ON q.run_label = r.run_label AND q.note = r.note GROUP BY r.run_label, r.note, r.text),
    redacted AS (SELECT run_label, note, head || substring(text, CAST(last + 1 AS BIGINT)) AS redacted FROM parts)
"""
RUNS = f"texts AS ({TEXTS}), runs AS (SELECT DISTINCT a.run_label, a.note, t.text FROM audit a JOIN texts t ON t.note = a.note)"
SPLICED = f"{PLAN}, {RUNS}, {SPLICE_OF}"

OUTCOMES = f"""
    {SPLICED},
    gold AS (SELECT item_id, note, item_group, CASE WHEN item_group = 'should_redact' THEN pii_type WHEN item_group = 'should_not_flag' THEN 'decoy' ELSE 'med' END AS kind, {norm('text')} AS n FROM synthetic_notes_key),
    red AS (SELECT run_label, note, {norm('redacted')} AS red FROM redacted),
    fnd AS (SELECT DISTINCT run_label, note, {norm('original')} AS o, coalesce(label = 'medication', false) AS med FROM audit),
    pairs AS (SELECT item_id, run_label, g.note, kind, n, n <> '' AND contains(red, n) AS kept FROM gold g JOIN red r ON r.note = g.note),
    near AS (
        SELECT DISTINCT p.item_id, p.run_label FROM pairs p JOIN fnd f ON f.run_label = p.run_label AND f.note = p.note
        WHERE n <> '' AND o <> '' AND (kind <> 'med' OR med) AND (contains(o, n) OR contains(n, o))),
    outcomes AS (
        SELECT p.item_id, p.run_label, p.note, kind, kept, q.item_id IS NOT NULL AS detected,
               CASE WHEN kind IN ('direct', 'quasi') THEN NOT kept WHEN kind = 'decoy' THEN kept ELSE kept AND q.item_id IS NOT NULL END AS hit
        FROM pairs p LEFT JOIN near q ON q.item_id = p.item_id AND q.run_label = p.run_label)
"""

# A word begins and ends where letters, digits and underscores do; RE2 has no lookaround, so each pattern is
# tried where a word begins, and what follows it is matched along.
W_, S_, D_ = r"[\p{L}\p{N}_]", r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]", r"\p{Nd}"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[a-zA-Z]{2,}"
PHONE = rf"(?:\+46|0046|0)(?:{S_}|-)?[0-9]{{1,4}}(?:{S_}|-)?[0-9]{{3}}(?:{S_}|-)?[0-9]{{2}}(?:{S_}|-)?[0-9]{{2}}"
BOUNDED = {
    2: rf"07[0-9](?:{S_}|-)?{D_}{{3}}(?:{S_}|-)?{D_}{{2}}(?:{S_}|-)?{D_}{{2}}", 3: rf"(?:19|20)?{D_}{{6}}(?:{S_}|-){D_}{{4}}", 4: rf"[A-Z]{{2}}{D_}{{7}}",
    5: rf"{D_}{{4}}[-/]{D_}{{2}}[-/]{D_}{{2}}", 6: rf"{D_}{{1,2}}{S_}+{W_}+{S_}+{D_}{{4}}", 7: rf"{D_}{{1,2}}[-/]{D_}{{1,2}}[-/]{D_}{{2,4}}", 8: rf"{D_}{{3}}{S_}?{D_}{{2}}",
}
RULE_LABELS = ("private_email", "private_phone", "private_phone", "account_number", "account_number", "private_date", "private_date", "private_date", "private_address")
TRIED = " UNION ALL ".join(
    rf"SELECT note_id, CAST({n} AS BIGINT) AS n, s, regexp_extract(substring(text, CAST(s + 1 AS BIGINT)), '(?i)^({p})(?:[^\p{{L}}\p{{N}}_]|$)', 1) AS txt FROM begins" for n, p in BOUNDED.items()
)
RULES = rf"""
    begins AS (SELECT w.note_id, s, n.text FROM ({matches('notes', 'note_id', 'text', W_ + '+')}) w JOIN notes n ON n.note_id = w.note_id WHERE regexp_matches(w.txt, '^[0-9a-zA-Z\p{{Nd}}]')),
    tried AS (SELECT note_id, n, CAST(s AS BIGINT) AS s, CAST(s + length(txt) AS BIGINT) AS e, txt FROM ({TRIED}) WHERE txt <> ''),
    apart AS (
        SELECT note_id, n, list_reduce(list(struct_pack(s := s, e := e, txt := txt) ORDER BY s), lambda a, x: CASE WHEN x.s >= a[-1].e THEN list_append(a, x) ELSE a END, [struct_pack(s := -1::BIGINT, e := -1::BIGINT, txt := '')])[2:] AS kept
        FROM tried GROUP BY note_id, n),
    spans AS (
        SELECT note_id, CAST(0 AS BIGINT) AS n, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, txt FROM ({matches('notes', 'note_id', 'text', EMAIL)})
        UNION ALL SELECT note_id, 1, CAST(s AS BIGINT), CAST(e AS BIGINT), txt FROM ({matches('notes', 'note_id', 'text', PHONE)})
        UNION ALL SELECT note_id, n, k.s, k.e, k.txt FROM (SELECT note_id, n, unnest(kept) AS k FROM apart)),
    named AS (SELECT *, ['{"', '".join(RULE_LABELS)}'][n + 1] AS label FROM spans),
    ranked AS (SELECT *, label IN {DIRECT_LIST} AS direct, row_number() OVER (PARTITION BY note_id ORDER BY n, s) AS seq FROM named),
    stood AS (
        SELECT note_id, list_reduce(list(struct_pack(s := s, e := e, txt := txt, label := label) ORDER BY direct DESC, e - s DESC, seq),
               lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.s < x.e AND y.e > x.s)) = 0 THEN list_append(a, x) ELSE a END, [struct_pack(s := -1::BIGINT, e := -1::BIGINT, txt := '', label := '')])[2:] AS kept
        FROM ranked GROUP BY note_id),
    ruled AS (SELECT note_id, CAST(generate_subscripts(kept, 1) - 1 AS BIGINT) AS seq, unnest(kept) AS k FROM stood)
"""
def words(known: dict[str, tuple[str, str, str]], table: str, key: str) -> str:
    """(key, seq, i, w, label, risk, g, s): the first whole-word place of each known word in each text."""
    rows = ", ".join(f"({i}, '{w}', '{label}', '{risk}', '{g}')" for i, (w, (label, risk, g)) in enumerate(known.items()))
    return rf"""
        words AS (SELECT * FROM (VALUES {rows}) AS t(i, w, label, risk, g)),
        spots AS (SELECT {key}, w.*, length(regexp_extract(text, '^(.*?(?:^|[^\p{{L}}\p{{N}}]))' || w || '(?:[^\p{{L}}\p{{N}}]|$)', 1, 's')) AS s FROM {table}, words w
               WHERE regexp_matches(text, '(?:^|[^\p{{L}}\p{{N}}])' || w || '(?:[^\p{{L}}\p{{N}}]|$)')),
        claimed AS (SELECT *, CAST(row_number() OVER (PARTITION BY {key} ORDER BY i) - 1 AS BIGINT) AS seq FROM spots)
    """


WORDS = words(NOTE_WORDS, "notes", "note_id")
FOUND = rf"""
    {RULES}, {WORDS},
    ents AS (
        SELECT '' AS run_label, note_id AS note, seq, k.txt AS txt, k.label AS label, k.s AS s, k.e AS e, 'rule' AS source, CAST(NULL AS VARCHAR) AS g FROM ruled
        UNION ALL SELECT '', note_id, 1000000 + seq, w, label, s, s + length(w), 'llm', g FROM claimed)
"""
# New mentions of ``ents`` in ``runs``, in order of discovery.
MENTIONS = rf"""
    own AS (SELECT run_label, note, seq, 0 AS k, txt AS needle FROM ents WHERE txt <> ''),
    name_parts AS (
        SELECT run_label, note, seq, k, trim(p, '.,') AS needle
        FROM (SELECT run_label, note, seq, generate_subscripts(ps, 1) AS k, unnest(ps) AS p FROM (SELECT run_label, note, seq, string_split_regex(txt, '{S_}+') AS ps FROM ents WHERE label = 'private_person' AND txt <> ''))
        WHERE length(trim(p, '.,')) >= 3 AND regexp_matches(trim(p, '.,'), '^\p{{Lu}}') AND lower(trim(p, '.,')) NOT IN ('dr', 'dr.', 'professor', 'prof', 'prof.')),
    needles AS (SELECT run_label, note, needle, arg_min(seq, (seq, k)) AS seq, min((seq, k)) AS turn FROM (SELECT * FROM own UNION ALL SELECT * FROM name_parts) GROUP BY run_label, note, needle),
    cut AS (SELECT n.*, r.text, string_split(r.text, n.needle) AS gaps FROM needles n JOIN runs r ON r.run_label = n.run_label AND r.note = n.note WHERE contains(r.text, n.needle)),
    occ AS (
        SELECT run_label, note, seq, turn, text, needle, i, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + (i - 1) * length(needle) AS BIGINT) AS s
        FROM (SELECT *, unnest(generate_series(1, len(gaps) - 1)) AS i FROM cut)),
    whole AS (
        SELECT run_label, note, seq, turn, needle, s, s + length(needle) AS e, substring(text, s, 1) AS before, substring(text, s + length(needle) + 1, 1) AS after FROM occ),
    bounded AS (
        SELECT * FROM whole
        WHERE (s > 0 AND regexp_matches(before, '^{W_}')) <> regexp_matches(needle, '^{W_}') AND regexp_matches(after, '^{W_}') <> regexp_matches(needle, '{W_}$')),
    turns AS (SELECT run_label, note, list(struct_pack(seq := seq, s := s, e := e, needle := needle) ORDER BY turn, s) AS new FROM bounded GROUP BY run_label, note),
    held AS (SELECT run_label, note, list(struct_pack(seq := -1::BIGINT, s := s, e := e, needle := '')) AS known FROM ents WHERE s < e GROUP BY run_label, note),
    grown AS (
        SELECT t.run_label, t.note, list_filter(list_reduce(new, lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.s < x.e AND y.e > x.s)) = 0 THEN list_append(a, x) ELSE a END,
               coalesce(known, [struct_pack(seq := -1::BIGINT, s := -1::BIGINT, e := -1::BIGINT, needle := '')])), lambda y: y.seq >= 0) AS kept
        FROM turns t LEFT JOIN held h ON h.run_label = t.run_label AND h.note = t.note)
"""

RATES = ", ".join(
    f"round(100.0::DOUBLE * count(*) FILTER (kind = '{k}' AND hit) / nullif(count(*) FILTER (kind = '{k}'), 0), 6) AS {n}" for k, n in (("direct", "direct"), ("quasi", "quasi"), ("decoy", "decoys"), ("med", "meds"))
)

SOLID = r"[^\s\x{0b}\x{85}\p{Z}]+"
TAGS = f"""
    toks AS (SELECT row_id, CAST(i - 1 AS BIGINT) AS tok_idx, CAST(s AS BIGINT) AS cs, CAST(e AS BIGINT) AS ce FROM ({matches('sv_pure3', 'row_id', 'source_text', SOLID)})),
    masks AS (SELECT row_id, i AS span_seq, m.start_pos AS s, m.end_pos AS e, {case_map('m.label', MASK)} AS category
              FROM (SELECT row_id, generate_subscripts(privacy_mask, 1) AS i, unnest(privacy_mask) AS m FROM sv_pure3 WHERE privacy_mask IS NOT NULL)),
    hits AS (SELECT t.row_id, tok_idx, span_seq, category, row_number() OVER (PARTITION BY t.row_id, span_seq ORDER BY tok_idx) AS r
             FROM toks t JOIN masks m ON m.row_id = t.row_id AND cs < m.e AND ce > m.s WHERE category IS NOT NULL),
    best AS (SELECT row_id, tok_idx, arg_max(CASE WHEN r = 1 THEN 'B-' ELSE 'I-' END || category, span_seq) AS tag FROM hits GROUP BY row_id, tok_idx),
    tags AS (SELECT t.row_id, t.tok_idx, cs, ce, coalesce(tag, 'O') AS tag FROM toks t LEFT JOIN best b ON b.row_id = t.row_id AND b.tok_idx = t.tok_idx)
"""
DECODED = f"""
    {TAGS},
    lab AS (SELECT *, CASE WHEN tag <> 'O' THEN {case_map("substring(tag, 3)", MODEL, "substring(tag, 3)")} END AS label FROM tags),
    fresh AS (SELECT *, CASE WHEN label IS NOT NULL AND (tag LIKE 'B-%' OR lag(label) OVER (PARTITION BY row_id ORDER BY tok_idx) IS DISTINCT FROM label) THEN 1 ELSE 0 END AS f FROM lab),
    isl AS (SELECT *, sum(f) OVER (PARTITION BY row_id ORDER BY tok_idx) AS island FROM fresh),
    decoded AS (SELECT row_id, min(cs) AS start_pos, max(ce) AS end_pos, label, count(*) AS tokens FROM isl WHERE label IS NOT NULL GROUP BY row_id, island, label)
"""


def f_scores(by: str) -> str:
    head = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    p, r = "coalesce(correct / nullif(predicted, 0)::DOUBLE, 0)", "coalesce(correct / nullif(gold, 0)::DOUBLE, 0)"
    return f"""
        WITH {DECODED},
        g AS (SELECT DISTINCT row_id, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, {case_map('category', MODEL)} AS label, 1 AS g FROM masks WHERE category IS NOT NULL),
        q AS (SELECT DISTINCT row_id, start_pos AS s, end_pos AS e, label, 1 AS p FROM decoded),
        b AS (SELECT {"coalesce(g.label, q.label) AS label, " if by else ""} g.g, q.p FROM g FULL JOIN q ON g.row_id = q.row_id AND g.s = q.s AND g.e = q.e AND g.label = q.label),
        c AS (SELECT {head} count(g) AS gold, count(p) AS predicted, count(*) FILTER (g IS NOT NULL AND p IS NOT NULL) AS correct FROM b {group})
        SELECT {head} gold, predicted, correct, round({p}, 9) AS "precision", round({r}, 9) AS recall,
               round(coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0), 9) AS f1, round(coalesce(5 * {p} * {r} / nullif(4 * {p} + {r}, 0), 0), 9) AS f2 FROM c
    """


FLAGS = """
    flags AS (SELECT note, audit_id AS seq, source AS judge, concat_ws(' ', coalesce(original, ''), generalized_to) AS quote, label AS reason FROM audit)
"""
TOKENS = "|".join(rf"\[{p[1:-1]}\]" for p in sorted({*PLACEHOLDERS.values(), FALLBACK}))
MISREAD = rf"""
    regexp_matches(quote, '{TOKENS}') AND NOT regexp_matches(regexp_replace(quote, '{TOKENS}', '', 'g'), '\p{{Nd}}')
    AND len(list_filter(list_filter(string_split_regex(regexp_replace(quote, '{TOKENS}', '', 'g'), '[\s\p{{Z}}]+'), lambda w: w <> '')[2:],
            lambda w: regexp_matches(regexp_replace(w, '^[,.():;"'']+', ''), '^\p{{Lu}}'))) = 0
"""


def panel(votes: int) -> str:
    return f"""
        WITH {FLAGS}, v AS (SELECT note, quote, count(DISTINCT judge) AS votes, arg_min(reason, seq) AS reason, arg_min(judge, seq) AS judge FROM flags WHERE quote <> '' GROUP BY note, quote)
        SELECT note, quote, reason, judge, votes FROM v WHERE votes >= {votes} AND NOT ({MISREAD})
    """


GREEDY = f"""
    WITH RECURSIVE ents AS ({ENTITIES}),
    rk AS (SELECT *, row_number() OVER (PARTITION BY run_label, note ORDER BY coalesce(label IN {DIRECT_LIST}, false) DESC, e - s DESC, seq) AS r FROM ents),
    step AS (
        SELECT run_label, note, CAST(0 AS BIGINT) AS r, CAST([] AS STRUCT(seq BIGINT, s BIGINT, e BIGINT, r BIGINT)[]) AS acc FROM (SELECT DISTINCT run_label, note FROM ents)
        UNION ALL
        SELECT k.run_label, k.note, k.r, CASE WHEN len(list_filter(p.acc, lambda a: k.s < a.e AND k.e > a.s)) > 0 THEN p.acc ELSE list_append(p.acc, {{'seq': k.seq, 's': k.s, 'e': k.e, 'r': k.r}}) END
        FROM step p JOIN rk k ON k.run_label = p.run_label AND k.note = p.note AND k.r = p.r + 1),
    fin AS (SELECT run_label, note, arg_max(acc, r) AS acc FROM step GROUP BY run_label, note),
    acc AS (SELECT run_label, note, unnest(acc).seq AS seq, generate_subscripts(acc, 1) - 1 AS rank FROM fin),
    kept AS (SELECT k.*, a.rank FROM acc a JOIN rk k ON k.run_label = a.run_label AND k.note = a.note AND k.seq = a.seq),
    bad AS (
        SELECT DISTINCT a.run_label, a.note, a.seq FROM kept a JOIN rk x ON x.run_label = a.run_label AND x.note = a.note AND x.r > a.r AND x.s < a.e AND x.e > a.s
        WHERE {strip('x.txt')} <> '' AND a.g IS NOT NULL AND (x.source IN {GT_LIST} OR contains(lower({strip('a.g')}), lower({strip('x.txt')}))
              OR (length({strip('x.txt')}) > 3 AND lower({strip('x.txt')}) LIKE '%s' AND contains(lower({strip('a.g')}), left(lower({strip('x.txt')}), length({strip('x.txt')}) - 1)))))
    SELECT k.run_label, k.note, CAST(k.rank AS BIGINT) AS rank, k.seq, k.label, k.s AS start_pos, k.e AS end_pos, CASE WHEN b.seq IS NULL THEN k.g END AS generalized
    FROM kept k LEFT JOIN bad b ON b.run_label = k.run_label AND b.note = k.note AND b.seq = k.seq
"""

CLUSTERS = f"""
    WITH ents AS (SELECT * FROM ({ENTITIES}) WHERE e > s AND {strip('txt')} <> ''),
    reach AS (SELECT *, max(e) OVER (PARTITION BY run_label, note ORDER BY s, s - e, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ents),
    isl AS (SELECT *, sum(CASE WHEN m IS NULL OR s >= m THEN 1 ELSE 0 END) OVER (PARTITION BY run_label, note ORDER BY s, s - e, seq ROWS UNBOUNDED PRECEDING) AS island FROM reach),
    ord AS (SELECT *, row_number() OVER (PARTITION BY run_label, note, island ORDER BY coalesce(label IN {sql_list(VERBATIM)}, false), e - s DESC, coalesce(label IN {DIRECT_LIST}, false) DESC, s, seq) AS r,
                   min(s) OVER (PARTITION BY run_label, note, island) AS lo, max(e) OVER (PARTITION BY run_label, note, island) AS hi, count(*) OVER (PARTITION BY run_label, note, island) AS members FROM isl),
    dom AS (SELECT *, {replacement('txt', 'label', 'g')} AS own FROM ord WHERE r = 1),
    leaks AS (
        SELECT DISTINCT d.run_label, d.note, d.island FROM dom d JOIN isl x ON x.run_label = d.run_label AND x.note = d.note AND x.island = d.island AND x.seq <> d.seq
        WHERE contains(lower(own), lower({strip('x.txt')})) OR (length({strip('x.txt')}) > 3 AND lower({strip('x.txt')}) LIKE '%s' AND contains(lower(own), left(lower({strip('x.txt')}), length({strip('x.txt')}) - 1))))
    SELECT d.run_label, d.note, lo AS start_pos, hi AS end_pos, members,
           CASE WHEN members = 1 OR (s = lo AND e = hi AND NOT starts_with(own, '[') AND l.island IS NULL AND NOT coalesce(label IN {DIRECT_LIST}, false)) THEN own ELSE {case_map('label', PLACEHOLDERS, repr(FALLBACK))} END AS replacement
    FROM dom d LEFT JOIN leaks l ON l.run_label = d.run_label AND l.note = d.note AND l.island = d.island
"""

NL = "[^" + chr(10) + "]"
UNITS = rf"""
    lines AS (SELECT note_id, s AS ls, txt, row_number() OVER () AS lid FROM ({matches('notes', 'note_id', 'text', NL + r'+' + chr(10) + '?|' + chr(10))})),
    stops AS (SELECT lid, s, e FROM ({matches('lines', 'lid', 'txt', '[.!?]+')})),
    good AS (SELECT t.lid, t.e FROM stops t JOIN lines l ON l.lid = t.lid
             WHERE (t.e = length(txt) OR regexp_matches(substring(txt, CAST(t.e + 1 AS BIGINT), 1), '^[\s\p{{Z}}\x{{0b}}\x{{85}}]'))
               AND lower(regexp_extract(substring(txt, 1, CAST(t.s AS BIGINT)), '([\p{{L}}\p{{N}}_]+)\.?$', 1)) NOT IN {sql_list(ABBREVIATIONS)}),
    ends AS (SELECT lid, e FROM good UNION SELECT lid, length(txt) FROM lines),
    units AS (SELECT note_id, ls + coalesce(lag(e) OVER (PARTITION BY n.lid ORDER BY e), 0) AS s, ls + e AS e FROM ends n JOIN lines l ON l.lid = n.lid)
"""

SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
CHUNK_END = r"\.[\t\r\f \x{0b}\x{1c}-\x{1f}\x{85}\p{Z}][" + SPACE + "]*|" + chr(10)
CHUNKS = f"""
    m AS (SELECT row_id, e AS p FROM ({matches('sv_pure3', 'row_id', 'source_text', CHUNK_END)})),
    b AS (SELECT row_id, p, false AS z FROM m UNION ALL SELECT row_id, length(source_text), true FROM sv_pure3 WHERE source_text IS NOT NULL),
    c AS (SELECT row_id, row_number() OVER w - 1 AS chunk_no, coalesce(lag(p) OVER w, 0) AS s, p AS e FROM b WINDOW w AS (PARTITION BY row_id ORDER BY p, z)),
    k AS (SELECT c.*, privacy_mask FROM c JOIN sv_pure3 r ON r.row_id = c.row_id WHERE regexp_matches(substring(source_text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)), '[^{SPACE}]'))
"""

RENDERED = f"""
    WITH c AS ({CLUSTERS}), texts AS ({TEXTS}),
    runs AS (SELECT DISTINCT a.run_label, a.note, t.text FROM audit a JOIN texts t ON t.note = a.note),
    q AS (SELECT *, lag(end_pos) OVER w AS pe, lag(replacement) OVER w AS pr FROM c WINDOW w AS (PARTITION BY run_label, note ORDER BY start_pos)),
    p AS (
        SELECT r.run_label, r.note, r.text, max(end_pos) AS last,
               string_agg(substring(r.text, CAST(coalesce(pe, 0) + 1 AS BIGINT), CAST(start_pos - coalesce(pe, 0) AS BIGINT)) || CASE WHEN coalesce(pe = start_pos AND pr = replacement, false) THEN '' ELSE replacement END, '' ORDER BY start_pos) AS head
        FROM runs r LEFT JOIN q ON q.run_label = r.run_label AND q.note = r.note GROUP BY r.run_label, r.note, r.text)
    SELECT run_label, note, coalesce(head || substring(text, CAST(last + 1 AS BIGINT)), text) AS rendered FROM p
"""

GAZETTEER = rf"""
    names AS (SELECT wikidata_id, {case_map("coalesce(category, '')", CATEGORY_LABELS, "'private_address'")} AS label, variant, {strip('raw')} AS name
              FROM (SELECT wikidata_id, category, 0 AS variant, label_sv AS raw FROM gazetteer UNION ALL SELECT wikidata_id, category, 1, label_en FROM gazetteer) WHERE raw IS NOT NULL),
    w AS (SELECT *, string_split_regex(name, '[\s\p{{Z}}]+') AS ws FROM names),
    sh AS (SELECT *, regexp_replace(regexp_replace(lower(ws[-1]), '^[.,]+', ''), '[.,]+$', '') AS last, array_to_string(ws[1:len(ws)-1], ' ') AS short FROM w),
    forms AS (
        SELECT wikidata_id, variant, 0 AS form, label, name FROM sh WHERE length(name) >= 4
        UNION ALL
        SELECT wikidata_id, variant, 1, label, short FROM sh WHERE len(ws) >= 2 AND last IN {sql_list(SUFFIXES)} AND length(short) >= 4 AND NOT (len(ws) = 2 AND lower(short) IN {sql_list(GENERIC)})),
    patterns AS (SELECT lower(name) AS key, name, label FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY wikidata_id, variant, form, name) AS n FROM forms) WHERE n = 1)
"""


AUDIT_LOG = f"""SELECT run_label, note, row_number() OVER (PARTITION BY run_label, note ORDER BY start_pos, audit_id) AS position, original, label, start_pos, end_pos, source, risk,
            {replacement('original', 'label', 'generalized_to')} AS generalized_to FROM audit"""

# A mask widened to the words at its edges, relabelled, then folded over the rest.
WORDLIKE = r"[\p{L}\p{N}-]"

def repaired(base: str) -> str:
    """done(row_id, c): the repaired spans of ``base`` m(row_id, t, i, s0, e0, label), in order."""
    return rf"""
    {base},
    inner_ AS (SELECT *, substring(t, CAST(s0 + 1 AS BIGINT), CAST(e0 - s0 AS BIGINT)) AS x FROM m WHERE s0 <= e0),
    bare AS (SELECT *, s0 + length(regexp_extract(x, '^{S_}*')) AS s1, greatest(s0 + length(regexp_extract(x, '^{S_}*')), e0 - length(regexp_extract(x, '{S_}*$'))) AS e1 FROM inner_),
    wide AS (SELECT *, s1 - length(regexp_extract(substring(t, 1, CAST(s1 AS BIGINT)), '{WORDLIKE}*$')) AS s, e1 + length(regexp_extract(substring(t, CAST(e1 + 1 AS BIGINT)), '^{WORDLIKE}*')) AS e FROM bare),
    shown AS (SELECT *, substring(t, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) AS w FROM wide),
    meant AS (SELECT row_id, t, i, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, CASE WHEN label = 'private_person' AND regexp_matches(w, '\p{{Nd}}') THEN 'demographics' ELSE label END AS label, w FROM shown),
    kept AS (SELECT * FROM meant WHERE label IS DISTINCT FROM 'private_email' OR contains(w, '@')),
    done AS (
        SELECT row_id, list_reduce(list(struct_pack(s := s, e := e, label := label, t := t) ORDER BY s, i), lambda a, x: CASE
               WHEN a[-1].label = x.label AND regexp_matches(substring(x.t, a[-1].e + 1, greatest(0, x.s - a[-1].e)), '^{S_}*\.?{S_}*$')
               THEN list_append(a[:-2], struct_pack(s := a[-1].s, e := x.e, label := x.label, t := x.t)) ELSE list_append(a, x) END, CAST([] AS STRUCT(s BIGINT, e BIGINT, label VARCHAR, t VARCHAR)[])) AS c
        FROM kept GROUP BY row_id)
    """


MASKED = f"""
    m AS (
        SELECT row_id, source_text AS t, i, greatest(0, x.start_pos) AS s0, least(length(source_text), x.end_pos) AS e0,
               coalesce({case_map(case_map('x.label', MASK), MODEL)}, x.label) AS label
        FROM (SELECT row_id, source_text, generate_subscripts(privacy_mask, 1) AS i, unnest(privacy_mask) AS x FROM sv_pure3 WHERE source_text IS NOT NULL AND privacy_mask IS NOT NULL))
"""
REPAIR = f"WITH {repaired(MASKED)} SELECT row_id, CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS n, unnest(c).s AS start_pos, unnest(c).e AS end_pos, unnest(c).label AS label FROM done"
# Runs of words of one category that the stand-in token model is sure of.
SURE = {w: MODEL[c] for w, c in NAMED.items() if w not in UNSURE}
TAGGED = rf"""
    k AS (SELECT note_id, i, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, {case_map('txt', SURE)} AS label FROM ({matches('notes', 'note_id', 'text', r'[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]')})),
    f AS (SELECT *, CASE WHEN lag(label) OVER (PARTITION BY note_id ORDER BY i) IS NOT DISTINCT FROM label THEN 0 ELSE 1 END AS fresh FROM k),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY note_id ORDER BY i) AS island FROM f),
    m AS (SELECT x.note_id AS row_id, n.text AS t, min(i) AS i, min(s) AS s0, max(e) AS e0, label FROM g x JOIN notes n ON n.note_id = x.note_id WHERE label IS NOT NULL GROUP BY x.note_id, n.text, island, label)
"""
_FLAT = strip("replace(coalesce(original, ''), chr(10), ' ')")
def tuning(order: str, generalized: str = "generalized_to") -> str:
    return f"""
    {RUNS},
    f AS (SELECT run_label, note, start_pos, audit_id, {_FLAT} AS x, label, nullif({generalized}, '') AS g, label IN {sql_list(HIGH_RISK)} AS high FROM audit WHERE label IS NOT NULL),
    j AS (SELECT run_label, note, '[' || string_agg('{{"text":' || to_json(x) || ',"label":' || to_json(label) || ',"risk":"' || CASE WHEN high THEN 'high' ELSE 'medium' END || '"' || CASE WHEN g IS NULL THEN '' ELSE ',"generalized":' || to_json(g) END || '}}', ',' ORDER BY {order}) || ']' AS out
          FROM f WHERE x <> '' GROUP BY run_label, note),
    tuned AS (SELECT r.run_label, r.note, 'Hitta identifierande uppgifter och svara med JSON.' AS system_prompt, text AS user_input, coalesce(out, '[]') AS assistant_output FROM runs r LEFT JOIN j ON j.run_label = r.run_label AND j.note = r.note)
"""

HITS = rf"""
    {GAZETTEER}, toks AS ({matches('notes', 'note_id', 'text', r'[\p{L}\p{N}]+')}),
    core AS (SELECT *, regexp_replace(key, '[^\p{{L}}\p{{N}}]+$', '') AS c FROM patterns),
    size AS (SELECT max(len(regexp_extract_all(c, '[\p{{L}}\p{{N}}]+'))) AS most FROM core),
    grams AS (SELECT a.note_id, a.s, b.e FROM toks a JOIN toks b ON b.note_id = a.note_id JOIN size ON b.i BETWEEN a.i AND a.i + most - 1 WHERE regexp_matches(a.txt, '^\p{{Lu}}')),
    slices AS (SELECT g.note_id, s, e, substring(n.text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) AS txt, n.text FROM grams g JOIN notes n ON n.note_id = g.note_id),
    near AS (SELECT x.*, label, length(key) - length(c) AS more, key FROM slices x JOIN core ON c = lower(x.txt)),
    hits AS (
        SELECT note_id, CAST(s AS BIGINT) AS s, CAST(e + more AS BIGINT) AS e, substring(text, CAST(s + 1 AS BIGINT), CAST(e + more - s AS BIGINT)) AS txt, label FROM near
        WHERE more = 0 OR (lower(substring(text, CAST(s + 1 AS BIGINT), CAST(e + more - s AS BIGINT))) = key AND NOT regexp_matches(substring(text, CAST(e + more + 1 AS BIGINT), 1), '[\p{{L}}\p{{N}}]')))
"""
# Rules, gazetteer and their further mentions: a whole run without models.
WHOLE = rf"""
    {RULES}, {HITS},
    chosen AS (
        SELECT note_id, list_reduce(list(struct_pack(s := s, e := e, txt := txt, label := label) ORDER BY label IN {DIRECT_LIST} DESC, e - s DESC, s * 1048576 + e),
               lambda a, x: CASE WHEN len(list_filter(a, lambda y: y.s < x.e AND y.e > x.s)) = 0 THEN list_append(a, x) ELSE a END, CAST([] AS STRUCT(s BIGINT, e BIGINT, txt VARCHAR, label VARCHAR)[])) AS kept
        FROM hits GROUP BY note_id),
    first_ AS (
        SELECT note_id, seq, k.txt AS txt, k.label AS label, k.s AS s, k.e AS e, 'rule' AS source FROM ruled
        UNION ALL SELECT note_id, 1000000 + k.s * 1048576 + k.e, k.txt, k.label, k.s, k.e, 'gazetteer' FROM (SELECT note_id, unnest(kept) AS k FROM chosen)),
    runs AS (SELECT '' AS run_label, note_id AS note, text FROM notes WHERE text IS NOT NULL),
    found AS (SELECT '' AS run_label, note_id AS note, seq, txt, label, s, e, source, CAST(NULL AS VARCHAR) AS g FROM first_),
    {MENTIONS.replace("FROM ents", "FROM found")},
    more AS (SELECT note, CAST(generate_subscripts(kept, 1) AS BIGINT) AS n, unnest(kept) AS k FROM grown),
    ents AS (
        SELECT * FROM found
        UNION ALL SELECT '', m.note, 10000000000000 + m.n, m.k.needle, f.label, m.k.s, m.k.e, 'propagated', NULL FROM more m JOIN found f ON f.note = m.note AND f.seq = m.k.seq)
"""
WHOLE_AUDIT = f"""
    WITH {WHOLE} SELECT note AS note_id, row_number() OVER (PARTITION BY note ORDER BY s, seq) AS position, txt AS original, label, s AS start_pos, e AS end_pos, source, 'high' AS risk,
    {replacement('txt', 'label', 'g')} AS generalized_to FROM ents
"""


def sql() -> dict[str, str]:
    spans = lambda p: f"SELECT note_id, CAST(s AS BIGINT) AS start_pos, CAST(e AS BIGINT) AS end_pos, txt AS text FROM ({matches('notes', 'note_id', 'text', p)})"
    stage = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SOURCES)) + " END"
    budget = lambda base: f"CAST({base} + greatest(4096, 2 * t) AS BIGINT)"
    seeds = ", ".join(f"round(avg({k}), 4) AS {k}_mean, min({k}) AS {k}_min, max({k}) AS {k}_max" for k in ("direct", "quasi", "decoys", "meds"))
    zero = ", ".join(f"coalesce({k}, 0) AS {k}" for k in ("direct", "quasi", "decoys", "meds"))
    runs = "('modell_a_s1', 'modell_a_s2', 'modell_b_s1')"
    values = lambda rows: ", ".join(f"({a}, '{b}')" for a, b in rows)
    taxonomy = ", ".join(f"('{k}', '{v}', {k in DIRECT}, {k in PROTECTED}, false)" for k, v in PLACEHOLDERS.items()) + ", ('medication', NULL, false, false, true)"
    return {
        "rule_spans_email": spans(EMAIL),
        "rule_spans_phone": spans(PHONE),
        "rule_spans": f"WITH {RULES} SELECT note_id, n AS pattern_no, label, s AS start_pos, e AS end_pos, txt AS text FROM named",
        "rule_entities": f"WITH {RULES} SELECT note_id, seq, k.label AS label, k.s AS start_pos, k.e AS end_pos, k.txt AS text FROM ruled",
        "rule_label_counts": f"WITH {RULES} SELECT k.label AS label, count(*) AS n FROM ruled GROUP BY ALL",
        "redact_notes": f"""
            WITH {RULES}, ents AS (SELECT '' AS run_label, note_id AS note, seq, k.txt AS txt, k.label AS label, k.s AS s, k.e AS e, 'rule' AS source, CAST(NULL AS VARCHAR) AS g FROM ruled),
            {PLAN_OF}, runs AS (SELECT '' AS run_label, note_id AS note, text FROM notes), {SPLICE_OF}
            SELECT note_id, coalesce(redacted, text) AS redacted FROM notes LEFT JOIN redacted ON note = note_id""",
        "model_entities": f"""
            WITH {repaired(TAGGED)}, u AS (SELECT row_id, generate_subscripts(c, 1) - 1 AS seq, unnest(c) AS x FROM done)
            SELECT row_id AS note_id, CAST(seq AS BIGINT) AS seq, substring(x.t, x.s + 1, x.e - x.s) AS text, x.label AS label, x.s AS start_pos, x.e AS end_pos FROM u""",
        "model_tokens": rf"""
            WITH t AS (SELECT note_id, i, txt, {case_map('txt', NAMED)} AS c FROM ({matches('notes', 'note_id', 'text', r'[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]')})),
            g AS (SELECT *, CASE WHEN lag(c) OVER (PARTITION BY note_id ORDER BY i) IS NOT DISTINCT FROM c THEN 'I-' ELSE 'B-' END || c AS tag FROM t)
            SELECT tag, count(*) AS n, count(*) FILTER (txt NOT IN {sql_list(UNSURE)}) AS counted FROM g WHERE c IS NOT NULL GROUP BY tag""",
        "mock_entities": f"WITH {words(MOCK_KEYWORDS, 'documents', 'doc_id')} SELECT doc_id, seq, w AS text, label, CAST(s AS BIGINT) AS start_pos, CAST(s + length(w) AS BIGINT) AS end_pos, 'llm' AS source, g AS generalized, risk FROM claimed",
        "deidentified_text": f"""
            WITH {WHOLE}, {PLAN_OF}, {SPLICE_OF} SELECT note_id, coalesce(redacted, text) AS redacted FROM notes LEFT JOIN redacted ON note = note_id""",
        "deidentified_audit": WHOLE_AUDIT,
        "backstop_audit": WHOLE_AUDIT,
        "word_entities": f"WITH {WORDS} SELECT note_id, seq, w AS text, label, CAST(s AS BIGINT) AS start_pos, CAST(s + length(w) AS BIGINT) AS end_pos, 'llm' AS source, g AS generalized, risk FROM claimed",
        "plain_text": f"""
            WITH {FOUND}, {PLAN_OF}, runs AS (SELECT '' AS run_label, note_id AS note, text FROM notes), {SPLICE_OF}
            SELECT note_id, coalesce(redacted, text) AS redacted, false AS needs_review FROM notes LEFT JOIN redacted ON note = note_id""",
        "plain_generalized": f"""
            WITH {WORDS} SELECT label, CASE WHEN label NOT IN {sql_list((*DIRECT, *VERBATIM))} THEN 'generaliserad ' || label END AS generalized, count(*) AS n, count(*) FILTER (label NOT IN {sql_list((*DIRECT, *VERBATIM))}) AS filled
            FROM claimed GROUP BY label""",
        "judged_notes": rf"""
            WITH {FOUND}, {PLAN_OF}, runs AS (SELECT '' AS run_label, note_id AS note, text FROM notes), {SPLICE_OF},
            first AS (SELECT note_id, text, coalesce(redacted, text) AS red FROM notes LEFT JOIN redacted ON note = note_id),
            flag AS (  -- digits beside a placeholder were cut out of a longer run, so no claim can be placed on them
                SELECT *, regexp_matches(red, '(?:^|[^\p{{L}}\p{{N}}])[0-9]{{6,}}(?:[^\p{{L}}\p{{N}}]|$)') AS digits, regexp_matches(red, '(?:^|[^\p{{L}}\p{{N}}])[0-9]{{6,}}\[|\][0-9]{{6,}}(?:[^\p{{L}}\p{{N}}]|$)') AS beside FROM first),
            free AS (SELECT *, regexp_matches(regexp_replace(red, '[0-9]{{6,}}\[|\][0-9]{{6,}}', '#', 'g'), '(?:^|[^\p{{L}}\p{{N}}])[0-9]{{6,}}(?:[^\p{{L}}\p{{N}}]|$)') AS placed FROM flag)
            SELECT note_id, coalesce(beside, false) AS needs_review, beside AS digits_left, coalesce(placed, false) AS retried FROM free""",
        "propagated": f"""
            WITH ents AS ({ENTITIES}), {RUNS}, {MENTIONS}
            SELECT run_label, note, CAST(generate_subscripts(kept, 1) - 1 AS BIGINT) AS n, unnest(kept).seq AS seq, unnest(kept).s AS start_pos, unnest(kept).e AS end_pos, unnest(kept).needle AS text FROM grown""",
        "gazetteer_patterns": f"WITH {GAZETTEER} SELECT key, name, label FROM patterns",
        "gazetteer_spans": f"WITH {HITS} SELECT note_id, s AS start_pos, e AS end_pos, txt AS text, label FROM hits",
        "greedy_accept": GREEDY,
        "redaction_plan": f"WITH {PLAN} SELECT run_label, note, seq, label, source, start_pos, end_pos, whole, generalized FROM plan",
        "replacements": f"SELECT audit_id, {replacement('original', 'label', 'generalized_to')} AS replacement FROM audit",
        "replacements_no_generalize": f"SELECT audit_id, {replacement('original', 'label', 'generalized_to', True)} AS replacement FROM audit",
        "age_decades": f"SELECT audit_id, {age('original')} AS age_range FROM audit",
        "redacted_runs": f"WITH {SPLICED} SELECT run_label, note, redacted FROM redacted",
        "audit_log": AUDIT_LOG,
        "stage_counts": "SELECT run_label, source, count(*) AS n FROM audit GROUP BY run_label, source",
        "union_stages": f"SELECT run_label, note, row_number() OVER (PARTITION BY run_label, note ORDER BY {stage}, audit_id) AS seq, source, label, start_pos FROM audit WHERE source IN {sql_list(SOURCES)}",
        "taxonomy": f"SELECT * FROM (VALUES {taxonomy}) AS t(label, placeholder, direct, protected, verbatim)",
        "generalize_targets": f"SELECT audit_id, label FROM audit WHERE source = 'llm' AND label IS NOT NULL AND label NOT IN {sql_list((*DIRECT, *VERBATIM))}",
        "llm_claims": """
            SELECT run_label || '|' || note AS doc, row_number() OVER (PARTITION BY run_label, note ORDER BY audit_id) - 1 AS item, original AS text, coalesce(label, 'unknown') AS label, coalesce(risk, 'medium') AS risk,
                   nullif(generalized_to, '') AS generalized
            FROM audit WHERE source = 'llm' AND original IS NOT NULL AND length(original) >= 2""",
        "token_budgets": f"""WITH d AS (SELECT doc_id, CAST(ceil(n_chars / 4) AS BIGINT) AS t FROM documents WHERE n_chars IS NOT NULL)
            SELECT doc_id, {budget('greatest(2048, 2 * t)')} AS "full", {budget('greatest(512, t)')} AS quasi, {budget('1000')} AS targeted FROM d""",
        "quantization_tiers": f"""
            WITH r(backend, p) AS (VALUES {", ".join(f"('{name}', {billions})" for name, (_, _, billions) in REGISTRY.items())}), v(vram) AS (VALUES (NULL), (8), (16), (24), (40), (48), (80))
            SELECT backend, CAST(vram AS DOUBLE) AS vram, CASE WHEN vram IS NULL OR vram >= p * 2 * 1.2::DOUBLE THEN 'none' WHEN vram >= p * 1.6::DOUBLE THEN '8bit' ELSE '4bit' END AS tier FROM r, v""",
        "judge_panel": panel(1),
        "judge_votes": panel(2),
        "judge_first_flags": f"WITH {FLAGS} SELECT note, seq, judge, quote FROM (SELECT *, row_number() OVER (PARTITION BY note, quote ORDER BY seq) AS r FROM flags WHERE quote <> '') WHERE r = 1",
        "needs_review": f"WITH s AS ({panel(1)}), h AS (SELECT DISTINCT note FROM s), t AS ({TEXTS}) SELECT t.note, h.note IS NOT NULL AS needs_review FROM t LEFT JOIN h ON h.note = t.note",
        "sentence_units": f"WITH {UNITS} SELECT note_id, row_number() OVER (PARTITION BY note_id ORDER BY s) - 1 AS unit_no, CAST(s AS BIGINT) AS start_pos, CAST(e AS BIGINT) AS end_pos FROM units",
        "sentence_chunks": f"""
            WITH {UNITS}, packs AS (
                SELECT note_id, list_reduce(list(struct_pack(s := s, e := e) ORDER BY s), lambda a, x: CASE WHEN x.e - a[-1].s <= 1800 THEN list_append(a[:-2], struct_pack(s := a[-1].s, e := x.e)) ELSE list_append(a, x) END, CAST([] AS STRUCT(s BIGINT, e BIGINT)[])) AS c
                FROM (SELECT note_id, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM units) GROUP BY note_id)
            SELECT note_id, CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS chunk_no, unnest(c).s AS start_pos, unnest(c).e AS end_pos FROM packs""",
        "training_chunks": f"""WITH {CHUNKS} SELECT row_id, chunk_no, CAST(s AS BIGINT) AS start_pos, CAST(e AS BIGINT) AS end_pos,
            CAST(coalesce(len(list_filter(privacy_mask, lambda x: x.start_pos >= s AND x.end_pos <= e)), 0) AS BIGINT) AS n_spans,
            coalesce(array_to_string(list_transform(list_filter(privacy_mask, lambda x: x.start_pos >= s AND x.end_pos <= e), lambda x: (x.start_pos - s)::VARCHAR || ':' || (x.end_pos - s)::VARCHAR || ':' || coalesce(x.label, '')), ','), '') AS spans FROM k""",
        "review_rendered": RENDERED,
        "char_windows": """
            WITH n AS (SELECT doc_id, length(text) AS l FROM documents WHERE text IS NOT NULL AND text <> ''),
            w AS (SELECT doc_id, l, unnest(generate_series(0, CASE WHEN l <= 1000 THEN 0 ELSE CAST(ceil((l - 1000) / 950.0) AS BIGINT) END)) AS i FROM n)
            SELECT doc_id, CAST(i AS BIGINT) AS window_no, CAST(i * 950 AS BIGINT) AS start_pos, CAST(least(i * 950 + 1000, l) AS BIGINT) AS end_pos FROM w""",
        "token_tags": f"WITH {TAGS} SELECT row_id, tok_idx, cs, ce, tag FROM tags",
        "decoded_spans": f"WITH {DECODED} SELECT row_id, start_pos, end_pos, label, tokens FROM decoded",
        "ner_f_scores": f_scores(""),
        "ner_f_scores_by_label": f_scores("label"),
        "ner_report": f"""
            WITH r AS ({f_scores("label")}), t AS (SELECT sum(gold) AS gold, sum(predicted) AS predicted, sum(correct) AS correct FROM r),
            m AS (SELECT correct / predicted::DOUBLE AS p, correct / gold::DOUBLE AS q, gold FROM t)
            SELECT label, "precision", recall, f1, f2, gold AS support FROM r
            UNION ALL SELECT 'micro', round(p, 9), round(q, 9), round(2 * p * q / (p + q), 9), round(5 * p * q / (4 * p + q), 9), CAST(gold AS BIGINT) FROM m
            UNION ALL SELECT 'macro', round(avg("precision"), 9), round(avg(recall), 9), round(avg(f1), 9), round(avg(f2), 9), CAST(sum(gold) AS BIGINT) FROM r
            UNION ALL SELECT 'weighted', round(sum("precision" * gold) / sum(gold), 9), round(sum(recall * gold) / sum(gold), 9), round(sum(f1 * gold) / sum(gold), 9), round(sum(f2 * gold) / sum(gold), 9), CAST(sum(gold) AS BIGINT) FROM r""",
        "fragment_repair": REPAIR,
        "tuning_rows": f"WITH {tuning('audit_id')} SELECT run_label, note, system_prompt, user_input, assistant_output FROM tuned",
        "export_tuning_rows": f"WITH {tuning('start_pos, audit_id', strip('generalized_to'))} SELECT run_label, note, system_prompt, user_input, assistant_output FROM tuned",
        "export_ner_rows": f"""
            WITH {RUNS}, a AS (SELECT run_label, note, count(*) AS n, CAST(sum(end_pos) AS BIGINT) AS ends FROM audit WHERE label IS NOT NULL GROUP BY run_label, note)
            SELECT r.run_label, r.note, length(text) AS n_chars, coalesce(n, 0) AS n_spans, coalesce(ends, 0) AS ends FROM runs r LEFT JOIN a ON a.run_label = r.run_label AND a.note = r.note""",
        "gazetteer_file": "SELECT wikidata_id, nullif(label_en, '') AS label_en, nullif(label_sv, '') AS label_sv, category FROM gazetteer",
        "tuning_file": f"""
            WITH {tuning('audit_id')}, p AS (SELECT *, CASE WHEN CAST('0x' || left(md5(run_label || '|' || note || '|7'), 8) AS BIGINT) < 3435973836 THEN 'train' ELSE 'validation' END AS part FROM tuned)
            SELECT part, count(*) AS n, CAST(sum(length(user_input)) AS BIGINT) AS chars_in, CAST(sum(length(assistant_output)) AS BIGINT) AS chars_out FROM p GROUP BY part""",
        "review_file": f"""
            WITH {RUNS}, i AS (SELECT run_label, note, sum(CASE WHEN source IN {sql_list(SOURCES)} THEN 3 ELSE 2 END) AS items FROM audit GROUP BY run_label, note)
            SELECT r.run_label, count(*) AS tasks, CAST(sum(items) AS BIGINT) AS items, CAST(sum(length(text)) AS BIGINT) AS chars FROM runs r JOIN i ON i.run_label = r.run_label AND i.note = r.note GROUP BY r.run_label""",
        "score_misses": f"""
            WITH {OUTCOMES} SELECT run_label, o.note, kind, string_agg(coalesce(g.text, ''), '|' ORDER BY coalesce(g.text, '')) AS items FROM outcomes o JOIN synthetic_notes_key g ON g.item_id = o.item_id WHERE NOT hit GROUP BY run_label, o.note, kind""",
        "label_counts": f"WITH m AS (SELECT unnest(privacy_mask).label AS label FROM sv_pure3 WHERE privacy_mask IS NOT NULL) SELECT label, count(*) AS n, {case_map('label', MASK)} AS category FROM m GROUP BY label",
        "tag_vocabulary": "SELECT CAST(id AS BIGINT) AS id, tag FROM (VALUES " + values(enumerate(["O"] + [f"{p}-{c}" for c in CATEGORIES for p in "BI"])) + ") AS t(id, tag)",
        "train_split": """
            WITH h AS (SELECT row_id, row_number() OVER (ORDER BY md5(row_id::VARCHAR || '|42'), row_id) AS r, count(*) OVER () AS n FROM sv_pure3)
            SELECT row_id, CASE WHEN r <= floor(n * 0.8) THEN 'train' ELSE 'validation' END AS part FROM h""",
        "hash_split": "SELECT row_id, CASE WHEN CAST('0x' || left(md5(row_id::VARCHAR || '|42'), 8) AS BIGINT) < 3435973836 THEN 'train' ELSE 'validation' END AS part FROM sv_pure3",
        "score_items": f"WITH {OUTCOMES} SELECT item_id, run_label, note, kind, kept, detected, hit FROM outcomes",
        "score_notes": f"""WITH {OUTCOMES} SELECT run_label, kind, coalesce(note, 'TOTAL') AS note, count(*) AS total, count(*) FILTER (hit) AS hits, count(*) FILTER (detected) AS detected
            FROM outcomes GROUP BY GROUPING SETS ((run_label, kind, note), (run_label, kind))""",
        "score_compare": f"WITH {OUTCOMES} SELECT run_label, {RATES} FROM outcomes GROUP BY run_label",
        "score_seeds": f"""WITH {OUTCOMES}, c AS (SELECT run_label, {RATES} FROM outcomes GROUP BY run_label), z AS (SELECT regexp_replace(run_label, '_s(eed)?[0-9]+$', '') AS model, {zero} FROM c)
            SELECT model, count(*) AS n, {seeds} FROM z GROUP BY model""",
        "score_ensemble": f"""WITH {OUTCOMES}, o AS (SELECT * FROM outcomes WHERE run_label IN {runs}), f AS (SELECT note FROM o GROUP BY note HAVING count(DISTINCT run_label) = 3),
            b AS (SELECT item_id, kind, bool_or(hit) AS a, bool_and(kept) AS k, bool_or(detected) AS d FROM o WHERE note IN (SELECT note FROM f) GROUP BY item_id, kind)
            SELECT kind, count(*) AS total, count(*) FILTER (CASE WHEN kind IN ('direct', 'quasi') THEN a WHEN kind = 'decoy' THEN k ELSE k AND d END) AS hits FROM b GROUP BY kind""",
        "detector_compare": f"""
            WITH g AS (SELECT item_id, note, item_group, {norm('text')} AS n FROM synthetic_notes_key WHERE (item_group = 'should_redact' AND pii_type = 'direct') OR item_group = 'should_not_flag'),
            f AS (SELECT DISTINCT source, note, {norm('original')} AS o FROM audit),
            m AS (SELECT DISTINCT source, item_id, item_group FROM f JOIN g ON g.note = f.note AND n <> '' AND o <> '' AND (contains(n, o) OR contains(o, n))),
            c AS (SELECT source, count(*) FILTER (item_group = 'should_redact') AS covered, count(*) FILTER (item_group = 'should_not_flag') AS flagged FROM m GROUP BY source),
            s AS (SELECT source, count(*) AS findings FROM audit GROUP BY source),
            t AS (SELECT count(*) FILTER (item_group = 'should_redact') AS direct, count(*) FILTER (item_group = 'should_not_flag') AS decoys FROM g)
            SELECT s.source, findings, direct, coalesce(covered, 0) AS covered, decoys, decoys - coalesce(flagged, 0) AS decoys_kept FROM s LEFT JOIN c ON c.source = s.source, t""",
        "scored_notes": f"""
            WITH k AS (SELECT DISTINCT note FROM synthetic_notes_key), r AS (SELECT note, count(DISTINCT run_label) AS runs FROM audit GROUP BY note), t AS ({TEXTS})
            SELECT k.note, coalesce(runs, 0) AS runs, t.note IS NOT NULL AS has_text FROM k LEFT JOIN r ON r.note = k.note LEFT JOIN t ON t.note = k.note""",
        "review_regions": f"""
            WITH n AS (SELECT *, row_number() OVER (PARTITION BY run_label, note ORDER BY start_pos, audit_id) - 1 AS region FROM audit),
            x AS (
                SELECT *, 'label' AS from_name, 'labels' AS type, label AS value, 0 AS item,
                       'source: ' || source || '|confidence: ' || {case_map('source', {'rule': '1.00', 'bert': '0.95', 'gazetteer': '0.90', 'llm': '0.80'}, "'1.00'")}
                       || CASE WHEN coalesce(generalized_to, '') <> '' THEN '|generalized: ' || generalized_to ELSE '' END AS meta FROM n
                UNION ALL SELECT *, 'risk', 'choices', risk, 1, NULL FROM n
                UNION ALL SELECT *, 'source', 'choices', source, 2, NULL FROM n WHERE source IN {sql_list(SOURCES)})
            SELECT run_label, note, region, CAST(item AS BIGINT) AS item, 'ent_' || region AS id, from_name, type, start_pos, end_pos, original AS text, value, meta FROM x""",
        "review_round_trip": f"""SELECT run_label, note, coalesce(original, '') AS text, label, start_pos, end_pos, source, nullif({strip('generalized_to')}, '') AS generalized, coalesce(risk, 'low') AS risk FROM audit""",
        "review_clusters": CLUSTERS,
        "audit_file": AUDIT_LOG,
        "deliveries": """SELECT doc_id, note_id, coalesce(length(text), 0) AS n_chars FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY received_at DESC NULLS LAST, note_id DESC) AS r FROM notes) WHERE r = 1""",
    }
