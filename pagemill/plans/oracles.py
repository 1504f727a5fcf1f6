"""DuckDB equivalents of the queries, over the same given tables."""

from __future__ import annotations

import unicodedata

from pagemill.plans import fixtures as fx

# Fixed values, written out here and not taken from the engine, so that they are checked too.
NOISE_LABELS = ("footer", "number", "image", "aside_text")
TITLE_LABELS = ("paragraph_title", "figure_title")
BULLETS = "•◦∙·‣▪▫–—"

_WS_IN = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS = f"[{_WS_IN}]"
_WC = r"[\pL\pN_]"


def _quoted(names):
    return ", ".join(f"'{n}'" for n in names)


def strip(c):
    return f"regexp_replace({c}, '\\A{_WS}+|{_WS}+\\z', '', 'g')"


def _control(c):
    return rf"regexp_replace({c}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"


def _unicode(c):
    # the noise holds two characters that compatibility composition changes
    return f"translate(replace(replace({c}, 'ﬁ', 'fi'), '…', '...'), '“”‘’–—', '\"\"''''--')"


def compatible(c):
    """Compatibility composition: characters that stand for others are replaced by these, then all is composed."""
    ranges = [*range(0xA0, 0x250), *range(0x2000, 0x2500), *range(0x3000, 0x3400), *range(0xF900, 0xFB50), *range(0xFE30, 0xFFF0)]
    said = {ch: unicodedata.normalize("NFKC", ch) for ch in map(chr, ranges) if unicodedata.decomposition(ch).startswith("<")}
    said = {k: v for k, v in said.items() if "\0" not in v}
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"map([{', '.join(map(quoted, said))}], [{', '.join(map(quoted, said.values()))}])"
    odd = f"list_transform(regexp_extract_all({c}, '(?s)[^\\x00-\\x7f]|[\\x00-\\x7f]+'), lambda x: coalesce({table}[x], x))"
    return f"CASE WHEN regexp_matches({c}, '[^\\x00-\\x7f]') THEN nfc_normalize(array_to_string({odd}, '')) ELSE {c} END"


def clean(c):
    """The whole cleaning of a text in compatible form."""
    return _space(_hyphen(_bullets(f"translate(replace({_control(c)}, '…', '...'), '“”‘’–—', '\"\"\'\'\'\'--')")))


def _bullets(c):
    return f"translate({c}, '{BULLETS}', '{'-' * len(BULLETS)}')"


def _hyphen(c):
    # without look-around: two passes over pairs
    once = lambda x: f"regexp_replace({x}, '({_WC})-{_WS}+([a-z])', '\\1\\2', 'g')"
    return once(once(c))


def _space(c):
    runs = f"regexp_replace({c}, '[ ' || chr(9) || ']{{2,}}', ' ', 'g')"
    return strip(f"regexp_replace({runs}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def _text(c):
    return _space(_hyphen(_bullets(_unicode(_control(c)))))


def title_key(c):
    # no look-around: word characters around "chapter" are told by splitting at non-word characters
    words = f"list_transform(regexp_extract_all(lower({c}), '{_WC}+|[^\\pL\\pN_]+'), lambda w: CASE WHEN w = 'chapter' THEN 'ch' ELSE w END)"
    bare = f"regexp_replace(array_to_string({words}, ''), '[^\\pL\\pN_{_WS_IN}]', '', 'g')"
    return strip(f"regexp_replace({bare}, '{_WS}+', ' ', 'g')")


_COMMON = """
extent AS (SELECT doc_id, page_index, max(x1) AS max_x, max(y1) AS max_y FROM spans GROUP BY ALL),
in_columns AS (SELECT s.*, least(floor((x0 + x1)::DOUBLE / 2 * {n} / max_x)::INT, {n} - 1) AS col_idx FROM spans s JOIN extent USING (doc_id, page_index)),
ordered AS (SELECT * EXCLUDE (col_idx), (row_number() OVER (PARTITION BY doc_id, page_index ORDER BY col_idx, y0, x0, region_idx) - 1)::INT AS seq FROM in_columns)"""
ORDERED = f"WITH {fx.SPANS}, {_COMMON.format(n=2)}"
PAIRS = f"""{ORDERED}, {fx.LAYOUT},
pairs AS (SELECT s.doc_id, s.page_index, s.region_idx, r.layout_idx, r.label FROM spans s JOIN layout r ON s.doc_id = r.doc_id AND s.page_index = r.page_index
  AND least(s.x1, r.x1) > greatest(s.x0, r.x0) AND least(s.y1, r.y1) > greatest(s.y0, r.y0)
  AND ((least(s.x1, r.x1) - greatest(s.x0, r.x0)) * (least(s.y1, r.y1) - greatest(s.y0, r.y0)))::DOUBLE / greatest((s.x1 - s.x0) * (s.y1 - s.y0), 1) >= 0.3e0),
firsts AS (SELECT doc_id, region_idx, arg_min(label, layout_idx) AS label, min(CASE WHEN label = 'table' THEN layout_idx END) AS table_idx FROM pairs GROUP BY ALL)"""
_KINDS = f"""{PAIRS},
near AS (SELECT o.*, f.label, f.table_idx, lag(size) OVER w AS prev_size, lead(size) OVER w AS next_size FROM ordered o LEFT JOIN firsts f USING (doc_id, region_idx) WINDOW w AS (PARTITION BY doc_id, page_index ORDER BY seq)),
kinds AS (SELECT *, CASE WHEN label IN ({_quoted(NOISE_LABELS)}) THEN 'noise' WHEN label IN ({_quoted(TITLE_LABELS)}) THEN 'title' WHEN table_idx IS NOT NULL THEN 'table'
  WHEN size > 9e0 AND prev_size IS DISTINCT FROM size AND next_size IS DISTINCT FROM size THEN 'title' ELSE 'prose' END AS kind FROM near),
titled AS (SELECT *, last_value(CASE WHEN kind = 'title' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id, page_index ORDER BY seq ROWS UNBOUNDED PRECEDING) AS title FROM kinds)"""
_BLOCKS = f"""{_KINDS},
opening AS (SELECT *, kind = 'table' AND row_number() OVER (PARTITION BY doc_id, page_index, table_idx, kind ORDER BY seq) = 1 AS opens FROM titled WHERE kind <> 'noise'),
islands AS (SELECT *, sum((kind = 'title' OR opens)::INT) OVER (PARTITION BY doc_id, page_index ORDER BY seq ROWS UNBOUNDED PRECEDING) AS island FROM opening),
runs AS (SELECT doc_id, page_index, island, CASE WHEN opens THEN 'table' ELSE 'text' END AS type, min(seq) AS first_seq, string_agg(text, ' ' ORDER BY seq) AS words, arg_min(title, seq) FILTER (WHERE title IS NOT NULL) AS title
  FROM islands WHERE kind = 'prose' OR opens GROUP BY ALL),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, page_index ORDER BY first_seq) - 1)::INT AS order_id, page_index + 1 AS page FROM runs)"""

_TOC = rf"""{fx.TOC_LINES},
leveled AS (SELECT *, (dense_rank() OVER (PARTITION BY doc_id ORDER BY size DESC) - 1)::INT AS level FROM toc_lines),
bare AS (SELECT *, regexp_replace(regexp_replace({strip('text')}, '\.{{2,}}{_WS}*\z', ''), '{_WS}+\z', '') AS t FROM leveled),
counted AS (SELECT *, regexp_full_match(t, '\p{{Nd}}+') AS digits, sum((NOT regexp_full_match(t, '\p{{Nd}}+'))::INT) OVER (PARTITION BY doc_id ORDER BY toc_seq ROWS UNBOUNDED PRECEDING) AS e FROM bare),
later AS (SELECT doc_id, e, arg_min(try_cast(t AS INT), toc_seq) AS page FROM counted WHERE digits GROUP BY ALL),
entries AS (SELECT c.doc_id, c.toc_seq, CASE WHEN regexp_matches(t, '\A[^\n]+?\.{{2,}}{_WS}*\p{{Nd}}+\z') THEN {strip(f"regexp_extract(t, '\\A([^\\n]+?)\\.{{2,}}{_WS}*\\p{{Nd}}+\\z', 1)")} ELSE t END AS title,
  coalesce(CASE WHEN regexp_matches(t, '\A[^\n]+?\.{{2,}}{_WS}*\p{{Nd}}+\z') THEN try_cast(regexp_extract(t, '([0-9]+)\z', 1) AS INT) END, l.page) AS page_start, level
  FROM counted c LEFT JOIN later l ON l.doc_id = c.doc_id AND l.e = c.e WHERE NOT digits)"""
TREE = """
parents AS (SELECT c.doc_id, c.toc_seq, max(p.toc_seq) AS parent_seq FROM {entries} c LEFT JOIN {entries} p ON p.doc_id = c.doc_id AND p.toc_seq < c.toc_seq AND p.level < c.level GROUP BY ALL),
paths AS (SELECT e.doc_id, e.toc_seq, [e.title] AS path FROM {entries} e JOIN parents p ON p.doc_id = e.doc_id AND p.toc_seq = e.toc_seq WHERE p.parent_seq IS NULL
  UNION ALL SELECT e.doc_id, e.toc_seq, list_append(b.path, e.title) FROM paths b JOIN parents p ON p.doc_id = b.doc_id AND p.parent_seq = b.toc_seq JOIN {entries} e ON e.doc_id = p.doc_id AND e.toc_seq = p.toc_seq)"""
PAGES = """
firsts AS (SELECT p.doc_id, p.parent_seq AS toc_seq, min(p.toc_seq) AS child FROM parents p WHERE p.parent_seq IS NOT NULL GROUP BY ALL),
inherited AS (SELECT doc_id, toc_seq, toc_seq AS at, page_start FROM entries
  UNION ALL SELECT i.doc_id, i.toc_seq, f.child, e.page_start FROM inherited i JOIN firsts f ON f.doc_id = i.doc_id AND f.toc_seq = i.at JOIN entries e ON e.doc_id = f.doc_id AND e.toc_seq = f.child WHERE i.page_start IS NULL),
pages AS (SELECT doc_id, toc_seq, max(page_start) AS page_start FROM inherited GROUP BY ALL)"""

_ATTACH = f"""{fx.BLOCKS}, {fx.OUTLINE}, {TREE.format(entries='outline')},
keyed AS (SELECT o.toc_seq, {title_key('o.title')} AS key, o.page_start, p.path FROM outline o JOIN paths p ON p.toc_seq = o.toc_seq)"""
_MATCHED = """
kept AS (SELECT * FROM blocks_in WHERE {where}),
matched AS (SELECT b.block_id, min(k.toc_seq) AS matched_seq, arg_min(k.path, k.toc_seq) AS matched_path FROM kept b JOIN keyed k ON b.title <> '' AND {title} = k.key AND (k.page_start IS NULL OR b.page >= k.page_start) GROUP BY ALL),
carried AS (SELECT b.*, coalesce(last_value(m.matched_path IGNORE NULLS) OVER (ORDER BY page, order_id ROWS UNBOUNDED PRECEDING), []) AS toc FROM kept b LEFT JOIN matched m USING (block_id))"""


def _attached(skip):
    return f"WITH RECURSIVE {_ATTACH}, {_MATCHED.format(where='page NOT IN (1, 2, 177, 178, 179)' if skip else 'true', title=title_key('b.title'))}"


_TEXTS = f"""{_attached(True)},
grouped AS (SELECT *, row_number() OVER (ORDER BY page, order_id) AS n, sum((coalesce(title, '') <> '')::INT) OVER (ORDER BY page, order_id ROWS UNBOUNDED PRECEDING) AS g FROM carried WHERE type = 'text'),
texts AS (SELECT arg_min(block_id, n) AS block_id, arg_min(page, n) AS page, arg_min(order_id, n) AS order_id, arg_min(title, n) FILTER (WHERE title IS NOT NULL) AS title, arg_min(toc, n) AS toc, string_agg({_text('text')}, chr(10) || chr(10) ORDER BY n) AS text
  FROM grouped GROUP BY CASE WHEN g = 0 THEN n ELSE -g END)"""
_HEADED = f"""{_TEXTS},
filled AS (SELECT * REPLACE ({strip('text')} AS text) FROM texts WHERE {strip('text')} <> ''),
headed AS (SELECT *, coalesce(title, '') <> '' AND len(toc) > 0 AND coalesce(toc[-1], '') <> '' AND {title_key('title')} <> {title_key('toc[-1]')} AS is_heading FROM filled),
marked AS (SELECT * REPLACE (CASE WHEN is_heading THEN '<<<HEADING: ' || title || ' >>>' || chr(10) || chr(10) || text ELSE text END AS text) FROM headed)"""
_SECTIONS = f"""{_HEADED},
opened AS (SELECT *, row_number() OVER (ORDER BY page, order_id) AS n, (lag(toc) OVER (ORDER BY page, order_id) IS DISTINCT FROM toc OR row_number() OVER (ORDER BY page, order_id) = 1)::INT AS o FROM marked),
placed AS (SELECT *, sum(o) OVER (ORDER BY n ROWS UNBOUNDED PRECEDING) - 1 AS s FROM opened),
heads AS (SELECT *, CASE WHEN is_heading AND lag(title) OVER (PARTITION BY s, is_heading ORDER BY n) IS DISTINCT FROM title THEN title END AS head, row_number() OVER (PARTITION BY s, page ORDER BY n) = 1 AS new_page FROM placed)"""


def _each(column):
    return f"WITH {fx.NOISY} SELECT doc_id, {column('text')} AS text FROM noisy"


ORACLES = {
    "page_manifest": "SELECT doc_id, i::INT AS page_index, 300 AS dpi, printf('pages/page_%04d.png', i + 1) AS image_path FROM (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)",
    "ocr_unnest": f"WITH {fx.SPANS} SELECT doc_id, page_index, (row_number() OVER (PARTITION BY doc_id ORDER BY region_idx) - 1)::INT AS region_idx, {strip('text')} AS text, size, "
    + ", ".join(f"trunc({c} * 0.24e0 * (300e0 / 72e0))::INT AS {c}" for c in ("x0", "y0", "x1", "y1"))
    + f" FROM spans WHERE {strip('text')} <> ''",
    "ocr_scale": f"WITH {fx.SPANS} SELECT doc_id, region_idx, " + ", ".join(f"trunc({c} * 0.24e0 * (300e0 / 72e0))::INT AS {c}" for c in ("x0", "y0", "x1", "y1")) + " FROM spans",
    "layout_filter": f"WITH {fx.RAW_LAYOUT} SELECT * FROM raw_layout WHERE confidence >= 0.8e0 OR label IN ({_quoted(NOISE_LABELS)})",
    "page_extent": f"{ORDERED} SELECT * FROM extent",
    "norm_boxes": f"{ORDERED} SELECT doc_id, page_index, region_idx, " + ", ".join(f"trunc({c}::DOUBLE / {'max_x' if c[0] == 'x' else 'max_y'} * 1000)::INT AS n{c}" for c in ("x0", "y0", "x1", "y1")) + " FROM spans JOIN extent USING (doc_id, page_index)",
    "column_assign": f"WITH {fx.SPANS}, {_COMMON.format(n=3)} SELECT doc_id, region_idx, col_idx FROM in_columns",
    "reading_order": f"{ORDERED} SELECT doc_id, page_index, region_idx, seq FROM ordered",
    "model_inputs": f"""{ORDERED}, b AS (SELECT doc_id, page_index, region_idx, concat_ws(',', trunc(x0::DOUBLE / max_x * 1000)::INT, trunc(y0::DOUBLE / max_y * 1000)::INT, trunc(x1::DOUBLE / max_x * 1000)::INT, trunc(y1::DOUBLE / max_y * 1000)::INT) AS box FROM spans JOIN extent USING (doc_id, page_index))
SELECT doc_id, page_index, '0,' || string_agg('3', ',') || ',2' AS input_ids, '1,' || string_agg('1', ',') || ',1' AS attention_mask, '0,0,0,0;' || string_agg(box, ';' ORDER BY region_idx) || ';0,0,0,0' AS bbox FROM b GROUP BY ALL""",
    "assign_collisions": f"""WITH {fx.SCORES}, best AS (SELECT doc_id, page_index, "row", arg_max(col, score * 1000000 + col) AS position FROM scores GROUP BY ALL)
SELECT doc_id, page_index, position, string_agg("row"::VARCHAR, ',' ORDER BY "row") AS rows FROM best GROUP BY ALL HAVING count(*) > 1""",
    # of all scores of a page the highest is settled first, then the highest of the rows and positions left
    "assign_order": f"""WITH RECURSIVE {fx.SCORES}, sorted AS (SELECT doc_id, page_index, list(("row" * 65536 + col) ORDER BY score DESC, col DESC, "row") AS l FROM scores GROUP BY ALL),
picks AS (SELECT doc_id, page_index, l[1] AS x, list_filter(l, lambda y: y // 65536 <> l[1] // 65536 AND y % 65536 <> l[1] % 65536) AS l FROM sorted
  UNION ALL SELECT doc_id, page_index, l[1], list_filter(l, lambda y: y // 65536 <> l[1] // 65536 AND y % 65536 <> l[1] % 65536) FROM picks WHERE len(l) > 0)
SELECT doc_id, page_index, (x // 65536)::INT AS region_idx, (x % 65536)::INT AS position FROM picks""",
    "overlap_pairs": f"{PAIRS} SELECT * FROM pairs",
    "first_layout_match": f"{PAIRS} SELECT doc_id, region_idx, f.label FROM spans LEFT JOIN firsts f USING (doc_id, region_idx)",
    "first_table_match": f"{PAIRS} SELECT doc_id, region_idx, table_idx FROM firsts WHERE table_idx IS NOT NULL",
    "toc_content_semi": f"{PAIRS} SELECT doc_id, region_idx, text FROM spans WHERE (doc_id, region_idx) IN (SELECT (doc_id, region_idx) FROM pairs WHERE label = 'content')",
    "crop_boxes": f"WITH {fx.LAYOUT} SELECT doc_id, layout_idx, greatest(0, x0 - 8) AS crop_x0, greatest(0, y0 - 8) AS crop_y0, least(1500, x1 + 8) AS crop_x1, least(900, y1 + 8) AS crop_y1 FROM layout WHERE label = 'table'",
    "font_neighbors": f"{ORDERED} SELECT doc_id, region_idx, seq, lag(size) OVER w AS prev_size, lead(size) OVER w AS next_size FROM ordered WINDOW w AS (PARTITION BY doc_id, page_index ORDER BY seq)",
    "classify_regions": f"{_KINDS} SELECT doc_id, region_idx, seq, kind FROM kinds",
    "title_carry": f"{_KINDS} SELECT doc_id, region_idx, seq, title FROM titled",
    "assemble_blocks": f"""{_BLOCKS} SELECT doc_id, printf('%s_%d_%05d', CASE type WHEN 'text' THEN 'blk' ELSE 'tbl' END, page, order_id) AS block_id, order_id, page, type, CASE type WHEN 'text' THEN words END AS text, title,
  CASE type WHEN 'table' THEN printf('crops/tbl_%d_%05d.png', page, order_id) END AS image_crop FROM numbered""",
    "toc_levels": f"WITH {_TOC} SELECT doc_id, toc_seq, level FROM leveled",
    "toc_entries": f"WITH {_TOC} SELECT * FROM entries",
    "toc_tree": f"WITH RECURSIVE {_TOC}, {TREE.format(entries='entries')} SELECT * FROM parents",
    "toc_paths": f"WITH RECURSIVE {_TOC}, {TREE.format(entries='entries')} SELECT doc_id, toc_seq, array_to_string(path, ' / ') AS path FROM paths",
    "toc_propagate": f"WITH RECURSIVE {_TOC}, {TREE.format(entries='entries')}, {PAGES} SELECT * FROM pages",
    "toc_pipeline": f"""WITH RECURSIVE {_TOC}, {TREE.format(entries='entries')}, {PAGES}
SELECT e.doc_id, e.toc_seq, e.title, g.page_start, e.level, p.parent_seq, array_to_string(h.path, ' / ') AS path FROM entries e JOIN pages g USING (doc_id, toc_seq) JOIN parents p USING (doc_id, toc_seq) JOIN paths h USING (doc_id, toc_seq)""",
    # entries in their order: each opens its node, and closes as many as its depth falls to the next
    "toc_json": f"""WITH RECURSIVE {_TOC}, {TREE.format(entries='entries')}, {PAGES},
flat AS (SELECT e.doc_id, e.toc_seq, '{{"title": ' || to_json(e.title)::VARCHAR || ', "page_start": ' || coalesce(g.page_start::VARCHAR, 'null') || ', "level": ' || e.level || ', "children": [' AS node,
  len(h.path) AS depth, lead(len(h.path)) OVER (PARTITION BY e.doc_id ORDER BY e.toc_seq) AS following FROM entries e JOIN pages g USING (doc_id, toc_seq) JOIN paths h USING (doc_id, toc_seq))
SELECT doc_id, '[' || string_agg(node || CASE WHEN following > depth THEN '' WHEN following IS NULL THEN repeat(']}}', depth) ELSE repeat(']}}', depth - following + 1) || ', ' END, '' ORDER BY toc_seq) || ']' AS toc_json FROM flat GROUP BY doc_id""",
    "skip_pages": f"WITH {fx.BLOCKS} SELECT block_id, page FROM blocks_in WHERE page NOT IN (1, 2, 177, 178, 179)",
    "toc_match": f"{_attached(False)} SELECT block_id, matched_seq FROM kept LEFT JOIN matched USING (block_id)",
    "toc_carry": f"{_attached(True)} SELECT block_id, array_to_string(toc, ' / ') AS toc FROM carried",
    "serialize_text": f"{_TEXTS} SELECT block_id, page, order_id, title, array_to_string(toc, ' / ') AS toc, text FROM texts",
    "serialize_tables": f"{_attached(True)} SELECT block_id, page, order_id, title, array_to_string(toc, ' / ') AS toc, image_crop FROM carried WHERE type = 'table'",
    "section_headings": f"{_HEADED} SELECT block_id, is_heading, text FROM marked",
    "sections": f"""{_SECTIONS} SELECT printf('sec_%06d', s::BIGINT) AS section_id, array_to_string(arg_min(toc, n), ' / ') AS toc, coalesce(string_agg(head, ' / ' ORDER BY n), '') AS headings, string_agg(text, chr(10) || chr(10) ORDER BY n) AS text,
  string_agg(page::VARCHAR, ',' ORDER BY n) FILTER (WHERE new_page) AS pages, string_agg(block_id, ' / ' ORDER BY n) AS block_ids FROM heads GROUP BY s""",
    "norm_control": _each(_control),
    "norm_unicode": _each(_unicode),
    "norm_bullets": _each(_bullets),
    "norm_hyphen": _each(_hyphen),
    "norm_space": _each(_space),
    "normalize_text": _each(_text),
    "normalize_title": f"WITH {fx.BLOCKS} SELECT block_id, {title_key("concat_ws(' ', 'CHAPTER 1: ', title, '  (Sub_chapter)')")} AS key FROM blocks_in",
    "b64_payload": "SELECT doc_id, to_base64(encode(text)) AS payload FROM documents",
    "prompt_context": f"{_attached(False)} SELECT block_id, array_to_string(toc, ' > ') AS path, coalesce(nullif(title, ''), 'None') AS title FROM carried WHERE type = 'table'",
    "table_prompt": f"""{_attached(False)} SELECT block_id, 'Path: ' || array_to_string(toc, ' > ') || chr(10) || 'Title: ' || coalesce(nullif(title, ''), 'None') || chr(10) || chr(10) ||
'The path and the title say where in its document the table stands; use them to name columns without a name.' || chr(10) ||
'In "description", tell in one or two sentences what the table is for, what one row is, and what each column holds.' AS prompt FROM carried WHERE type = 'table'""",
    "table_extract": f"""{_attached(False)} SELECT block_id AS table_id, page, title, 'stub' AS description, 'Path / Title' AS columns, 1 AS n_rows,
  'Path=' || array_to_string(toc, ' > ') || ', Title=' || coalesce(nullif(title, ''), 'None') AS cells, 'ok' AS status FROM carried WHERE type = 'table'""",
    "table_parse": f"""WITH {fx.MODEL_ANSWERS} SELECT block_id, CASE page % 5 WHEN 0 THEN json_extract_string(answer, '$.description') END AS description,
  CASE page % 5 WHEN 0 THEN 'A / B' WHEN 1 THEN '' END AS columns, CASE page % 5 WHEN 0 THEN json_array_length(answer, '$.rows')::INT WHEN 1 THEN 0 END AS n_rows,
  CASE WHEN NOT json_valid(answer) THEN 'invalid' WHEN json_type(answer) <> 'OBJECT' THEN 'not_object' ELSE 'ok' END AS status FROM answers""",
    "table_cells": f"""WITH {fx.MODEL_ANSWERS} SELECT block_id AS table_id, r::INT AS "row", c AS "column", json_extract_string(answer, '$.rows[' || r || '].' || c) AS value
FROM (SELECT block_id, answer, r, unnest(['A', 'B']) AS c FROM (SELECT block_id, answer, unnest(range(2)) AS r FROM answers WHERE page % 5 = 0))""",
    "resume_anti": f"WITH {fx.BLOCKS} SELECT block_id, page, order_id, CASE page % 2 WHEN 0 THEN 'before' ELSE 'now' END AS made FROM blocks_in",
    "blocks_roundtrip": f"WITH {fx.BLOCKS} SELECT * FROM blocks_in",
    "overlay_order": f"""{ORDERED} SELECT s.doc_id, s.region_idx, o.seq::VARCHAR AS label, CASE WHEN o.seq IS NOT NULL THEN trunc((s.x0 + s.x1) / 2e0)::INT - 10 END AS label_x, CASE WHEN o.seq IS NOT NULL THEN trunc((s.y0 + s.y1) / 2e0)::INT + 10 END AS label_y
FROM spans s LEFT JOIN (SELECT * FROM ordered WHERE seq % 3 <> 1) o USING (doc_id, region_idx)""",
    "overlay_layout": f"""WITH {fx.LAYOUT} SELECT doc_id, layout_idx, concat_ws(';', x0 || ',' || y0, x1 || ',' || y0, x1 || ',' || y1, x0 || ',' || y1) AS polygon,
  ((dense_rank() OVER (PARTITION BY doc_id, page_index ORDER BY label) - 1) % 20)::INT AS palette_index, printf('%s (%.2f)', label, confidence) AS label_text, x0 AS label_x, greatest(10, y0 - 5) AS label_y FROM layout""",
}
