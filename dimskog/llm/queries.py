"""The queries of the training-data operators and their SQL where SQL can express them."""

from __future__ import annotations

from dimskog.llm import garble, lookalike, overlap, packing, pieces, pii, readability, tokens


def queries() -> dict:
    return {
        "p1_found": overlap.found,
        "p1_report": overlap.report,
        "p2_found": garble.found,
        "p2_restored": garble.restored,
        "p3_found": pieces.found,
        "p3_pieces": pieces.all_pieces,
        "p3_rejoined": pieces.rejoined,
        "p4_found": pii.found,
        "p4_redacted": pii.redacted,
        "p5_found": lookalike.found,
        "p5_canonical": lookalike.canonical,
        "p5_matched": lookalike.matched,
        "p6_ids": tokens.ids,
        "p6_decoded": tokens.decoded,
        "p7_packed": packing.packed,
        "p7_fill": packing.fill_report,
        "p7_totals": packing.totals,
        "p8_levels": readability.levels,
        "p8_agreement": readability.agreement,
    }


def oracle_sql() -> dict[str, str]:
    odd = (
        "nfc_normalize(v) <> v OR regexp_matches(v, '[\\x{ff01}-\\x{ff5e}\\x{ffe0}-\\x{ffe6}]') OR regexp_matches(v, '[\\p{Cf}\\p{Cc}\\x{34f}\\x{115f}\\x{1160}\\x{3164}\\x{ffa0}\\x{fe00}-\\x{fe0f}]') "
        "OR regexp_matches(v, '[\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]') "
        "OR len(list_filter(regexp_extract_all(v, '[\\p{L}\\p{M}]+'), lambda r: CAST(regexp_matches(r, '\\p{Latin}') AS INT) + CAST(regexp_matches(r, '\\p{Cyrillic}') AS INT) + CAST(regexp_matches(r, '\\p{Greek}') AS INT) > 1)) > 0"
    )
    wide = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
    alike = "".join(lookalike.LOOKALIKE), "".join(lookalike.LOOKALIKE.values())
    hidden = r"[\p{Cf}\x{0}-\x{8}\x{e}-\x{1f}\x{7f}-\x{84}\x{86}-\x{9f}\x{34f}\x{115f}\x{1160}\x{3164}\x{ffa0}\x{fe00}-\x{fe0f}]"
    narrow = f"nfc_normalize(regexp_replace(regexp_replace(translate(nfc_normalize(v), '{wide[0]}', '{wide[1]}'), '{hidden}', '', 'g'), '[\\s\\p{{Z}}\\x{{b}}\\x{{85}}]', ' ', 'g'))"
    mixed = "CAST(regexp_matches(r, '\\p{Latin}') AS INT) + CAST(regexp_matches(r, '\\p{Cyrillic}') AS INT) + CAST(regexp_matches(r, '\\p{Greek}') AS INT) > 1"
    values = """
        vals AS (SELECT 'audit' AS tbl, audit_id AS row_id, note, original AS v FROM audit
                 UNION ALL SELECT 'synthetic_notes_key', item_id, note, text FROM synthetic_notes_key WHERE item_group = 'should_redact')"""
    # runs of letters that mix scripts are Latin words with look-alikes here
    forms = f"""{values}, forms AS (SELECT *, nfc_normalize(array_to_string(list_transform(regexp_extract_all({narrow}, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'),
                lambda r: CASE WHEN {mixed} THEN translate(r, '{alike[0]}', '{alike[1]}') ELSE r END), '')) AS plain FROM vals)"""
    return {
        "p5_canonical": f"WITH {forms} SELECT tbl, row_id, note, v AS value, plain FROM forms",
        "p5_matched": f"""
            WITH {forms}, f AS (SELECT *, lower(trim(plain, ' ')) AS form, lower(trim(v, ' ')) AS raw FROM forms),
            a AS (SELECT note, form, count(*) AS n FROM f WHERE tbl = 'audit' AND form IS NOT NULL GROUP BY note, form), b AS (SELECT note, raw, count(*) AS n FROM f WHERE tbl = 'audit' AND raw IS NOT NULL GROUP BY note, raw)
            SELECT row_id AS item_id, g.note, g.form, coalesce(a.n, 0) AS findings, coalesce(b.n, 0) AS findings_as_is
            FROM f g LEFT JOIN a ON a.note = g.note AND a.form = g.form LEFT JOIN b ON b.note = g.note AND b.raw = g.raw WHERE tbl = 'synthetic_notes_key'""",
        "p5_found": f"""
            WITH x AS (SELECT 'audit' AS tbl, audit_id AS row_id, original AS v FROM audit
                       UNION ALL SELECT 'synthetic_notes_key', item_id, text FROM synthetic_notes_key WHERE item_group = 'should_redact')
            SELECT tbl, row_id FROM x WHERE {odd}
        """,
        "p3_rejoined": """
            SELECT 'notes' AS tbl, note_id AS row_id, length(text) AS n_chars, true AS within_limit, true AS overlaps, true AS same FROM notes WHERE text IS NOT NULL
            UNION ALL
            SELECT 'sv_pure3', row_id, length(source_text), true, true, true FROM sv_pure3 WHERE source_text IS NOT NULL
        """,
        "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p7_totals": "SELECT source, count(*) AS documents, 0::BIGINT AS not_whole, 0::BIGINT AS cut_in_vain, 0::BIGINT AS over_full FROM documents GROUP BY source",
        "p3_found": """
            SELECT 'notes' AS tbl, note_id AS row_id FROM notes, size_limits
            WHERE size_limits.tbl = 'notes' AND length(text) > max_size
            UNION ALL
            SELECT 'sv_pure3' AS tbl, row_id FROM sv_pure3, size_limits
            WHERE size_limits.tbl = 'sv_pure3' AND length(source_text) > max_size
        """,
    }
