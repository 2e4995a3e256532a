"""DuckDB SQL for the registered queries, written from the rules and not from the operators."""

from __future__ import annotations

from quirework.functions import rules

NL = "chr(10)"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _listed(xs) -> str:
    return "(" + ", ".join(map(_quoted, xs)) + ")"


# --- the book: documents as sections of manuals, see queries.book -----------------------------------

BOOK = """
d AS (
  SELECT doc_id AS n, doc_id // 100 AS doc_id,
         CASE coalesce(lang, '') WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 WHEN 'es' THEN 4 ELSE 5 END AS ch, coalesce(text, '') AS text,
         CASE doc_id % 24 WHEN 0 THEN 'Configuring Unit ' || doc_id WHEN 4 THEN 'Verifying Unit ' || doc_id WHEN 8 THEN 'Overview of Unit ' || doc_id
              WHEN 12 THEN 'Failure Recovery Unit ' || doc_id WHEN 16 THEN 'Unit Redundancy' WHEN 20 THEN 'Unit Redundancy' ELSE 'Installing Unit ' || doc_id END AS title
  FROM documents WHERE doc_id IS NOT NULL),
c AS (SELECT DISTINCT doc_id, ch, list_extract(['Alpha', 'Beta', 'Gamma', 'Delta', 'Omega'], ch) AS topic, NOT (ch = 3 AND doc_id % 2 = 1) AS toc FROM d),
raw AS (
  SELECT doc_id, ch, CAST(-1 AS BIGINT) AS n, 0 AS k, CAST(0 AS BIGINT) AS j, 'C H A P T E R ' || ch AS text FROM c
  UNION ALL SELECT doc_id, ch, -1, 1, 0, '' FROM c WHERE ch % 2 = 0
  UNION ALL SELECT doc_id, ch, -1, 2, 0, 'Topic ' || topic FROM c
  UNION ALL SELECT doc_id, ch, -1, 3, 0, 'intro for topic ' || topic || '.' FROM c
  UNION ALL SELECT doc_id, ch, -1, 4, 0, ' and a second line of it. ' FROM c WHERE ch = 2
  UNION ALL SELECT d.doc_id, d.ch, -1, 5, n, CASE WHEN n % 6 = 1 THEN '•' || title || ' ,  on  page ' || (n + 3) ELSE '  • ' || title || ', on page ' || (n + 3) END FROM d JOIN c ON c.doc_id = d.doc_id AND c.ch = d.ch WHERE toc
  UNION ALL SELECT doc_id, ch, -1, 6, 0, '' FROM c WHERE toc
  UNION ALL SELECT doc_id, ch, n, 0, 0, CASE WHEN n % 10 = 7 THEN 'Unlisted Part ' || n WHEN n % 24 = 8 THEN 'OVERVIEW  of Unit ' || n ELSE title END FROM d
  UNION ALL SELECT doc_id, ch, n, 1, 0, 'the section opens here with a plain sentence.' FROM d
  UNION ALL SELECT doc_id, ch, n, 2, 0, CASE WHEN n % 8 = 0 THEN 'Note' ELSE 'more of it follows below.' END FROM d
  UNION ALL SELECT doc_id, ch, n, 3, 0, list_extract(['Module Details', 'N9K-X9432PQ', 'GNU GRUB', 'Booting From Primary ROM Now', 'Related Topic', 'If The Link Fails', 'Module 3 powered up now'], n % 7 + 1) FROM d
  UNION ALL SELECT doc_id, ch, n, 4, 0, 'the ' || replace(text, chr(10), ' ') FROM d
  UNION ALL SELECT doc_id, ch, n, 5, 0, CASE WHEN n % 12 = 0 THEN 'Module Details' ELSE 'Other Details' END FROM d
  UNION ALL SELECT doc_id, ch, n, 6, 0, CASE WHEN n % 5 = 0 THEN 'short bit' ELSE 'the continuation of the same part.' END FROM d
  UNION ALL SELECT doc_id, ch, n, 7, 0, CASE WHEN n % 5 = 0 THEN ' Note ' ELSE 'Standby' END FROM d
  UNION ALL SELECT doc_id, ch, n, 8, 0, CASE WHEN n % 5 = 0 THEN 'the note follows its mark here, in one line.' ELSE 'the short tail.' END FROM d
  UNION ALL SELECT doc_id, ch, n, 9, 0, 'and it goes on in a second line of it.' FROM d WHERE n % 5 = 0
  UNION ALL SELECT doc_id, ch, n, 10, 0, 'stop here' FROM d WHERE n % 5 = 0
  UNION ALL SELECT doc_id, ch, n, 11, 0, 'the rest of it is plain and long enough.' FROM d WHERE n % 5 = 0
  UNION ALL SELECT d.doc_id, d.ch, n, 12, 0, 'Topic  ' || upper(topic) FROM d JOIN c ON c.doc_id = d.doc_id AND c.ch = d.ch WHERE n % 9 = 0),
book AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ch, n, k, j) - 1 AS BIGINT) AS line_no,
         CAST(CASE WHEN n < 0 THEN doc_id * 100 + 3 ELSE n + 3 END AS BIGINT) AS page_number, text FROM raw)
"""

_NEXT = "starts_with(after, 'The ') OR starts_with(after, 'A ') OR starts_with(after, 'This ') OR starts_with(after, 'Cisco ') OR starts_with(after, 'For ') OR starts_with(after, 'To ') OR starts_with(after, 'When ') OR starts_with(after, 'If ') OR starts_with(after, 'You ')"
_PREFIX = "|".join(rules.NON_HEADER_PREFIXES)
_SHAPE = rf"""length(s) BETWEEN 5 AND 60 AND regexp_matches(s, '^\p{{Lu}}') AND NOT regexp_matches(s, '[.,:;!?]$') AND NOT regexp_matches(s, '(switch|router)\s*[#(>]')
  AND NOT regexp_matches(s, '^[\d.\s]+$') AND NOT regexp_matches(s, '^[•-]') AND NOT regexp_matches(lower(s), '^({_PREFIX})') AND NOT (NOT contains(s, ' ') AND lower(s) = s)"""

#: Chapters, contents, anchors by an ordered fold, sections and subsections.
LINES = rf"""
WITH RECURSIVE {BOOK},
l AS (SELECT *, trim(text) AS s, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS norm, regexp_matches(trim(text), '^C\s+H\s+A\s+P\s+T\s+E\s+R\s+\d+$') AS mark FROM book),
l1 AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS chapter_idx,
              nullif(trim(regexp_extract(trim(text), '^•\s*(.+?),\s*on\s+page\s+\d+$', 1)), '') AS entry FROM l),
ch0 AS (SELECT doc_id, chapter_idx, min(line_no) AS ch_start, max(line_no) + 1 AS ch_end,
              CAST(max(CASE WHEN mark THEN regexp_extract(s, '(\d+)$', 1) END) AS BIGINT) AS chapter_number, min(page_number) AS page_start, max(page_number) AS page_end
       FROM l1 WHERE chapter_idx > 0 GROUP BY ALL),
ch1 AS (SELECT ch0.*, (SELECT min(line_no) FROM l1 WHERE l1.doc_id = ch0.doc_id AND l1.chapter_idx = ch0.chapter_idx AND line_no > ch_start AND s <> '') AS title_line FROM ch0),
ch2 AS (SELECT ch1.*, (SELECT min(line_no) FROM l1 WHERE l1.doc_id = ch1.doc_id AND l1.chapter_idx = ch1.chapter_idx AND line_no > title_line AND entry IS NOT NULL) AS first_entry FROM ch1),
ch AS (SELECT ch2.*, t.s AS chapter_title, coalesce((SELECT min(line_no) FROM l1 WHERE l1.doc_id = ch2.doc_id AND l1.chapter_idx = ch2.chapter_idx AND line_no > first_entry AND entry IS NULL AND s <> ''), ch_end) AS toc_end
       FROM ch2 JOIN l1 t ON t.doc_id = ch2.doc_id AND t.line_no = ch2.title_line),
intro AS (SELECT ch.doc_id, ch.chapter_idx, string_agg(s, ' ' ORDER BY line_no) AS chapter_summary FROM ch JOIN l1 USING (doc_id, chapter_idx)
          WHERE line_no > title_line AND line_no < coalesce(first_entry, ch_end) AND s <> '' GROUP BY ALL),
toc AS (SELECT doc_id, chapter_idx, row_number() OVER (PARTITION BY doc_id, chapter_idx ORDER BY line_no) - 1 AS i, entry AS title
        FROM l1 JOIN ch USING (doc_id, chapter_idx) WHERE entry IS NOT NULL AND line_no >= first_entry AND line_no < toc_end),
places AS (SELECT t.doc_id, t.chapter_idx, t.i, t.title, coalesce(list(b.line_no ORDER BY b.line_no) FILTER (b.line_no IS NOT NULL), []) AS at
           FROM toc t JOIN ch USING (doc_id, chapter_idx) LEFT JOIN l1 b ON b.doc_id = t.doc_id AND b.chapter_idx = t.chapter_idx AND b.line_no >= ch.toc_end AND b.norm = lower(regexp_replace(t.title, '\s+', ' ', 'g')) GROUP BY ALL),
fold AS (SELECT doc_id, chapter_idx, CAST(-1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS cursor, CAST(NULL AS BIGINT) AS line_no FROM ch
         UNION ALL
         SELECT f.doc_id, f.chapter_idx, p.i, coalesce(list_filter(p.at, lambda x: x >= f.cursor)[1] + 1, f.cursor), list_filter(p.at, lambda x: x >= f.cursor)[1]
         FROM fold f JOIN places p ON p.doc_id = f.doc_id AND p.chapter_idx = f.chapter_idx AND p.i = f.i + 1),
anchor AS MATERIALIZED (SELECT f.doc_id, f.chapter_idx, f.i AS toc_idx, p.title, f.line_no FROM fold f JOIN places p USING (doc_id, chapter_idx, i)),
x AS (SELECT l1.*, a.line_no IS NOT NULL AS is_sec, ch.chapter_title, ch.chapter_number,
             sum(CASE WHEN a.line_no IS NOT NULL THEN 1 ELSE 0 END) OVER w AS sec_idx, max(a.line_no) OVER w AS sec_line
      FROM l1 JOIN ch USING (doc_id, chapter_idx) LEFT JOIN anchor a ON a.doc_id = l1.doc_id AND a.line_no = l1.line_no
      WINDOW w AS (PARTITION BY l1.doc_id, l1.chapter_idx ORDER BY l1.line_no)),
x1 AS (SELECT x.*, t.title AS section_title, coalesce(nullif(lead(x.s, 1) OVER w, ''), nullif(lead(x.s, 2) OVER w, ''), nullif(lead(x.s, 3) OVER w, '')) AS after
       FROM x JOIN anchor t ON t.doc_id = x.doc_id AND t.line_no = x.sec_line WHERE sec_idx > 0 WINDOW w AS (PARTITION BY x.doc_id, x.chapter_idx, x.sec_idx ORDER BY x.line_no)),
x2 AS (SELECT *, NOT is_sec AND {_SHAPE} AND norm <> lower(chapter_title) AND norm <> lower(section_title)
                 AND norm NOT IN (SELECT lower(title) FROM anchor a WHERE a.doc_id = x1.doc_id AND a.chapter_idx = x1.chapter_idx AND a.line_no IS NOT NULL)
                 AND coalesce(regexp_matches(after, '^\p{{Ll}}') OR {_NEXT} OR (length(after) > 60 AND regexp_matches(after, '[.,:;!?]$')), false) AS is_h3 FROM x1),
y AS (SELECT *, sum(CASE WHEN is_h3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, chapter_idx, sec_idx ORDER BY line_no) AS h3_idx FROM x2),
z AS MATERIALIZED (SELECT *, max(CASE WHEN is_h3 THEN s END) OVER (PARTITION BY doc_id, chapter_idx, sec_idx, h3_idx) AS h3_title, CAST(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS BIGINT) AS words FROM y),
near AS (SELECT *, lag(s, 1) OVER w AS b1, lag(s, 2) OVER w AS b2, lag(s, 3) OVER w AS b3, lead(s, 1) OVER w AS a1, lead(s, 2) OVER w AS a2, lead(s, 3) OVER w AS a3
         FROM z WHERE NOT is_sec AND NOT is_h3 AND s <> '' WINDOW w AS (PARTITION BY doc_id, chapter_idx, sec_idx, h3_idx ORDER BY line_no)),
good AS (SELECT *, coalesce(length(b1) >= 30 OR regexp_matches(b1, '[.,:;!?]$'), false) AS g1, coalesce(length(b2) >= 30 OR regexp_matches(b2, '[.,:;!?]$'), false) AS g2, coalesce(length(b3) >= 30 OR regexp_matches(b3, '[.,:;!?]$'), false) AS g3,
                coalesce(length(a1) >= 30 OR regexp_matches(a1, '[.,:;!?]$'), false) AS f1, coalesce(length(a2) >= 30 OR regexp_matches(a2, '[.,:;!?]$'), false) AS f2, coalesce(length(a3) >= 30 OR regexp_matches(a3, '[.,:;!?]$'), false) AS f3
         FROM near WHERE s = 'Note'),
notes AS (SELECT doc_id, chapter_idx, sec_idx, h3_idx, line_no,
                 CASE WHEN g1 AND g2 AND g3 THEN b3 || ' ' || b2 || ' ' || b1 WHEN g1 AND g2 THEN b2 || ' ' || b1 WHEN g1 THEN b1
                      WHEN f1 AND f2 AND f3 THEN a1 || ' ' || a2 || ' ' || a3 WHEN f1 AND f2 THEN a1 || ' ' || a2 WHEN f1 THEN a1 END AS note FROM good WHERE g1 OR f1),
note_lists AS (SELECT doc_id, chapter_idx, sec_idx, h3_idx, list(note ORDER BY line_no) AS notes FROM notes GROUP BY ALL),
b AS (SELECT doc_id, chapter_idx, sec_idx, h3_idx, any_value(chapter_title) AS chapter_title, any_value(section_title) AS h2_title, any_value(h3_title) AS h3_title,
             trim(coalesce(string_agg(text, chr(10) ORDER BY line_no) FILTER (NOT is_sec AND NOT is_h3 AND norm <> lower(chapter_title) AND norm <> lower(coalesce(h3_title, section_title))), ''), ' ' || chr(10)) AS content,
             sum(words) FILTER (NOT is_sec AND NOT is_h3 AND norm <> lower(chapter_title) AND norm <> lower(coalesce(h3_title, section_title))) AS own,
             sum(words) FILTER (NOT is_sec AND norm <> lower(chapter_title) AND norm <> lower(section_title)) AS total, min(page_number) AS p0, max(page_number) AS p1
      FROM z GROUP BY doc_id, chapter_idx, sec_idx, h3_idx),
sec AS MATERIALIZED (SELECT b.doc_id, CAST(b.chapter_idx AS BIGINT) AS chapter_idx, row_number() OVER (PARTITION BY b.doc_id, b.chapter_idx ORDER BY sec_idx, h3_idx) - 1 AS pos,
               chapter_number, b.chapter_title, chapter_summary, coalesce(h3_title, h2_title) AS section_title, CASE WHEN h3_idx = 0 THEN 2 ELSE 3 END AS section_level,
               CASE WHEN h3_idx > 0 THEN h2_title END AS parent_section,
               CASE WHEN h3_idx = 0 THEN min(p0) OVER w ELSE p0 END AS page_start, CASE WHEN h3_idx = 0 THEN max(p1) OVER w ELSE p1 END AS page_end,
               content, CAST(CASE WHEN h3_idx = 0 THEN sum(total) OVER w ELSE coalesce(own, 0) END AS BIGINT) AS word_count,
               CAST(CASE WHEN h3_idx = 0 THEN max(h3_idx) OVER w ELSE 0 END AS BIGINT) AS h3_count, coalesce(notes, []) AS notes
        FROM b JOIN ch USING (doc_id, chapter_idx) JOIN intro USING (doc_id, chapter_idx) LEFT JOIN note_lists USING (doc_id, chapter_idx, sec_idx, h3_idx)
        WINDOW w AS (PARTITION BY b.doc_id, b.chapter_idx, b.sec_idx))
"""

_KEYWORDS = "|".join(rules.TITLE_KEYWORDS)
_ENDS = "|".join(rules.TITLE_END_KEYWORDS)


def judge_sql(title: str = "section_title", words: str = "word_count") -> tuple[str, str]:
    """(accepted, reason) of a subsection by its title and words."""
    t, low = f"trim({title})", f"lower(trim({title}))"
    head = rf"regexp_extract({low}, '^(\S*)', 1)"
    prose = f"'Title starts with sentence-starter ''' || {head} || ''' (looks like prose, not header)'"
    chain = [
        (f"length({t}) < 4", "false", "'Title too short (<4 chars)'"),
        (f"contains({head}, '-') AND split_part({head}, '-', 1) IN {_listed(rules.SENTENCE_STARTERS)}", "false", prose),
        (f"{head} IN {_listed(rules.SENTENCE_STARTERS)}", "false", prose),
        (f"{words} = 0", "false", "'Zero word content (empty section)'"),
        (f"regexp_matches({t}, '(?i){rules.PRODUCT_TITLE}')", "false", "'Cisco product/serial number pattern'"),
        (f"regexp_matches({t}, {_quoted('(?i)' + rules.LOG_TITLE)})", "false", "'Cisco syslog/CLI output line'"),
        (f"{low} IN {_listed(rules.STATUS_VALUES)}", "false", "'Pure status value'"),
        (f"{low} IN {_listed(rules.SYSTEM_STRINGS)}", "false", "'System/terminal output string'"),
        (f"len(list_filter([{', '.join(map(_quoted, rules.SYSTEM_STRINGS))}], lambda p: starts_with({low}, p))) > 0", "false",
         f"'Starts with system string: ''' || list_filter([{', '.join(map(_quoted, rules.SYSTEM_STRINGS))}], lambda p: starts_with({low}, p))[1] || ''''"),
        (f"{low} IN {_listed(rules.TABLE_HEADERS)}", "false", "'Table header repetition'"),
        (f"regexp_matches({t}, '{rules.DIGITS_SYMBOLS}')", "false", "'Mostly digits/symbols'"),
        (f"{words} >= 20", "true", f"'Sufficient content (' || {words} || ' words)'"),
        (rf"regexp_matches({t}, '(?i)\b({_KEYWORDS})\b') OR regexp_matches({t}, '(?i)\b({_ENDS})\s*$')", "true", f"'Keyword pattern (only ' || {words} || ' words content)'"),
    ]
    case = lambda i, rest: "CASE " + " ".join(f"WHEN {c[0]} THEN {c[i]}" for c in chain) + f" ELSE {rest} END"
    return case(1, "false"), case(2, f"'Insufficient content (' || {words} || ' words) and no keyword pattern'")


ACCEPTED, REASON = judge_sql()
MERGED = (
    LINES
    + rf""",
g AS (SELECT doc_id, chapter_idx, any_value(chapter_number) AS chapter_number, any_value(chapter_title) AS chapter_title, any_value(chapter_summary) AS chapter_summary, min(pos) AS pos, parent_section, section_title,
             string_agg(content, chr(10) || chr(10) ORDER BY pos) FILTER (content <> '') AS content, min_by(content, pos) AS first_content, min_by(page_start, pos) AS page_start, max(page_end) AS page_end, count(*) - 1 AS n_merged, min_by(word_count, pos) AS w0,
             flatten(list(notes ORDER BY pos)) AS notes
      FROM sec WHERE section_level = 3 GROUP BY doc_id, chapter_idx, parent_section, section_title),
m AS (SELECT * EXCLUDE (w0, content, first_content), CASE WHEN first_content = '' AND n_merged > 0 THEN coalesce(chr(10) || chr(10) || content, '') ELSE coalesce(content, '') END AS content,
             CAST(CASE WHEN n_merged > 0 THEN len(regexp_extract_all(coalesce(content, ''), '[^ \t\n\r\f\v]+')) ELSE w0 END AS BIGINT) AS word_count FROM g),
dec AS MATERIALIZED (SELECT *, {ACCEPTED} AS accepted, {REASON} AS reason FROM m),
kept AS (SELECT * FROM dec WHERE (doc_id, chapter_idx, section_title) IN (SELECT (doc_id, chapter_idx, section_title) FROM dec WHERE accepted)),
kids AS (SELECT doc_id, chapter_idx, parent_section AS section_title, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS kid_words, min(page_start) AS k0, max(page_end) AS k1, flatten(list(notes ORDER BY pos)) AS kid_notes,
                string_agg(chr(10) || chr(10) || chr(10) || '### ' || section_title || chr(10) || chr(10) || content, '' ORDER BY pos) AS kid_text,
                string_agg(chr(10) || chr(10) || '### Subsection: ' || section_title || chr(10) || chr(10) || content || CASE WHEN len(notes) > 0 THEN chr(10) || 'Subsection notes:' || chr(10) || '- ' || array_to_string(notes, chr(10) || '- ') ELSE '' END, '' ORDER BY pos) AS kid_source
         FROM kept GROUP BY ALL),
h2 AS (SELECT s.* EXCLUDE (h3_count), coalesce(n, 0) AS n_kids, coalesce(kid_words, 0) AS kid_words, coalesce(k0, page_start) AS k0, coalesce(k1, page_end) AS k1, coalesce(kid_notes, []) AS kid_notes, coalesce(kid_text, '') AS kid_text, coalesce(kid_source, '') AS kid_source
       FROM sec s LEFT JOIN kids USING (doc_id, chapter_idx, section_title) WHERE section_level = 2),
fin AS (SELECT doc_id, chapter_idx, pos, chapter_number, chapter_title, chapter_summary, section_title, 2 AS section_level, CAST(NULL AS VARCHAR) AS parent_section, page_start, page_end, content, notes, word_count, n_kids AS h3_count, kid_source FROM h2
        UNION ALL SELECT doc_id, chapter_idx, pos, chapter_number, chapter_title, chapter_summary, section_title, 3, parent_section, page_start, page_end, content, notes, word_count, 0, '' FROM kept)
"""
)

TYPE = r"""CASE WHEN regexp_matches(lower(section_title), 'troubleshooting|verifying|replacing|displaying|switchover possibilities|restart|failure|recovery') THEN 'troubleshooting'
 WHEN contains(lower(section_title), 'config') OR regexp_matches(lower(section_title), 'installing|enabling') THEN 'config'
 WHEN regexp_matches(substr(lower(content), 1, 500), 'configure terminal|switch\(config\)') THEN 'config' ELSE 'theory' END"""

UNITS = (
    MERGED
    + f""",
u AS (SELECT doc_id, chapter_idx, pos, CAST(0 AS BIGINT) AS sub, chapter_number, chapter_title, chapter_summary, section_title, 2 AS section_level, CAST(NULL AS VARCHAR) AS parent_section, page_start, page_end, content, word_count,
             word_count < 400 AND n_kids <= 2 AS small, n_kids, kid_words, k0, k1, notes, kid_notes, kid_text
      FROM h2 WHERE (word_count < 400 AND n_kids <= 2) OR word_count >= 100
      UNION ALL
      SELECT k.doc_id, k.chapter_idx, h2.pos, row_number() OVER (PARTITION BY k.doc_id, k.chapter_idx, h2.pos ORDER BY k.pos), k.chapter_number, k.chapter_title, k.chapter_summary, k.section_title, 3, h2.section_title,
             k.page_start, k.page_end, k.content, k.word_count, false, 0, 0, 0, 0, k.notes, [], ''
      FROM kept k JOIN h2 ON h2.doc_id = k.doc_id AND h2.chapter_idx = k.chapter_idx AND h2.section_title = k.parent_section
      WHERE NOT (h2.word_count < 400 AND n_kids <= 2)),
v AS (SELECT doc_id, chapter_idx, pos, sub, chapter_number, chapter_title, chapter_summary, section_title, section_level, parent_section, content, page_start, page_end, word_count, CASE WHEN small THEN n_kids ELSE 0 END AS n_children,
             CASE WHEN small THEN word_count + kid_words ELSE word_count END AS total_words, CASE WHEN small THEN least(page_start, k0) ELSE page_start END AS first_page, CASE WHEN small THEN greatest(page_end, k1) ELSE page_end END AS last_page,
             trim(CASE WHEN small THEN content || kid_text ELSE content END, ' ' || chr(10)) AS full_content, CASE WHEN small THEN list_concat(notes, kid_notes) ELSE notes END AS all_notes, {TYPE} AS suggested_type FROM u),
asked AS MATERIALIZED (SELECT *, CASE WHEN first_page = last_page THEN CAST(first_page AS VARCHAR) ELSE first_page || '-' || last_page END AS page_range,
  '# Source section' || {NL} || {NL} || 'Document: Book ' || doc_id || {NL} || 'Chapter ' || chapter_number || ': ' || chapter_title || {NL} || 'About the chapter: ' || chapter_summary || {NL}
  || 'Section: ' || section_title || ' (level ' || section_level || ')' || {NL} || 'Parent section: ' || coalesce(parent_section, 'None (a top-level section)') || {NL}
  || 'Pages: ' || CASE WHEN first_page = last_page THEN CAST(first_page AS VARCHAR) ELSE first_page || '-' || last_page END || {NL} || 'Words: ' || total_words || {NL} || 'Likely type: ' || suggested_type || {NL} || {NL} || '# Text' || {NL} || {NL} || full_content || {NL} || {NL}
  || CASE WHEN len(all_notes) > 0 THEN '## Notes found in this section' || {NL} || {NL} || '- ' || array_to_string(all_notes, {NL} || '- ') ELSE '' END || {NL} AS prompt FROM v),
stub AS (SELECT *, CAST('0x' || substr(md5(prompt), 1, 8) AS BIGINT) AS h FROM asked),
made AS MATERIALIZED (SELECT *, CASE WHEN h % 5 = 0 THEN 'skip' ELSE 'generate' END AS decision, CASE WHEN h % 5 <> 0 THEN CASE h % 4 WHEN 0 THEN 'config' WHEN 1 THEN 'theory' WHEN 2 THEN 'troubleshooting' ELSE suggested_type END END AS kb_type,
  CASE WHEN h % 5 <> 0 THEN 'unit-' || h % 1000 || '.md' END AS kb_filename, CASE WHEN h % 5 = 0 THEN 'cross-reference only' END AS skip_reason,
  CASE WHEN h % 5 <> 0 THEN '---' || {NL} || 'platform: ios-xe' || {NL} || 'id: unit-' || h || {NL} || '---' || {NL} || {NL} || 'body ' || h END AS kb_content FROM stub),
named AS (SELECT *, CASE WHEN decision = 'generate' THEN 'unit-' || h % 1000 || CASE WHEN row_number() OVER w > 1 THEN '-' || row_number() OVER w ELSE '' END END AS file_name
          FROM made WINDOW w AS (PARTITION BY doc_id, decision, h % 1000 ORDER BY chapter_idx, pos, sub))
"""
)

TITLE_FORM = r"trim(regexp_replace(regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}_]', ' ', 'g'), '\s+', ' ', 'g'))"
SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower({t}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled')"


def match_sql(drafts: str, sections: str) -> str:
    """CTEs named chosen and matched: drafts (doc_id, kb, kb_id, chapter, pages list) with their chapter and section."""
    form = lambda t: TITLE_FORM.format(t=t)
    bare = r"replace(regexp_replace(regexp_replace(kb_id, '^(nx-os-|nxos-|ios-xe-|iosxe-)', ''), '(-theory|-config|-troubleshooting)$', ''), '-', ' ')"
    return rf""",
numbered AS (SELECT q.*, (SELECT min(chapter_idx) FROM ch WHERE ch.doc_id = q.doc_id AND CAST(chapter_number AS VARCHAR) = regexp_extract(q.chapter, '(\d+)', 1)) AS by_number FROM {drafts} q),
chosen AS (SELECT numbered.*, CAST(coalesce(by_number, (SELECT min(chapter_idx) FROM ch WHERE ch.doc_id = numbered.doc_id AND chapter <> '' AND (contains({form("chapter")}, {form("chapter_title")}) OR contains({form("chapter_title")}, {form("chapter")})))) AS BIGINT) AS chapter_idx,
                  {form(bare)} AS want FROM numbered),
tried AS (SELECT c.doc_id, c.kb, c.chapter_idx, s.pos, s.section_level, CASE WHEN want <> '' AND want = {form("section_title")} THEN 0
                 WHEN length(want) >= 5 AND length({form("section_title")}) >= 5 AND (contains(want, {form("section_title")}) OR contains({form("section_title")}, want)) THEN 1 ELSE 2 END AS kind,
                 CASE WHEN len(pages) > 0 THEN greatest(0, least(pages[len(pages)], page_end) - greatest(pages[1], page_start) + 1) ELSE 0 END AS overlap, len(pages) > 0 AS paged
          FROM chosen c JOIN {sections} s ON s.doc_id = c.doc_id AND s.chapter_idx = c.chapter_idx),
matched AS (SELECT doc_id, kb, chapter_idx, pos, CASE kind WHEN 0 THEN 'title' WHEN 1 THEN 'title within' ELSE 'pages' END AS how
            FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kb ORDER BY kind, CASE WHEN kind = 2 AND paged THEN -overlap ELSE 0 END, CASE WHEN kind = 2 AND paged THEN section_level ELSE 0 END, pos) AS r FROM tried) WHERE r = 1)
"""


BOOK_DRAFTS = (
    LINES
    + f""",
drafts AS (SELECT doc_id, chapter_idx || '-' || pos AS kb,
  CASE WHEN pos % 11 = 10 THEN 'Nowhere' WHEN pos % 5 = 1 THEN chapter_title WHEN pos % 5 = 2 THEN 'The ' || chapter_title || ' Guide' ELSE 'Chapter ' || chapter_number END AS chapter,
  CASE pos % 7 WHEN 3 THEN 'ios-xe-all-about-' || {SLUG.format(t="section_title")} WHEN 4 THEN 'unit' WHEN 5 THEN '' ELSE 'nx-os-' || {SLUG.format(t="section_title")} || '-theory' END AS kb_id,
  CASE WHEN pos % 3 = 2 THEN [] ELSE [page_end, page_end + 1] END AS pages FROM sec)
"""
    + match_sql("drafts", "sec")
)

KB_DRAFTS = (
    UNITS
    + f""",
drafts0 AS (SELECT doc_id, chapter_idx || '-' || pos || '-' || sub || '.md' AS kb, (chapter_idx + pos + sub) % 13 AS kind, CASE WHEN (chapter_idx + pos + sub) % 13 = 7 THEN 'Nowhere' ELSE 'Chapter ' || chapter_number END AS chapter,
   'nx-os-' || {SLUG.format(t="section_title")} AS kb_id, [page_start, page_end] AS pages FROM named WHERE decision = 'generate'),
drafts1 AS (SELECT *, CASE WHEN kind = 5 THEN 'no front matter here' ELSE '---' || {NL} || 'id: ' || kb_id || {NL} || 'source:' || {NL} || '  chapter: ' || chapter || {NL} || '  pages: [' || pages[1] || ', ' || pages[2] || ']' || {NL} || '---' || {NL} || 'body' || {NL} END AS text FROM drafts0),
drafts AS (SELECT * FROM drafts1 WHERE kind <> 5)
"""
    + match_sql("drafts", "fin")
    + f""",
prepared AS (SELECT q.doc_id, q.kb, q.kind, q.chapter, q.pages, q.text, m.pos, f.section_title,
   'Chapter context: ' || f.chapter_summary || {NL} || {NL} || 'Section: ' || f.section_title || {NL} || {NL} || 'Content:' || {NL} || f.content || f.kid_source || CASE WHEN len(f.notes) > 0 THEN {NL} || 'Notes:' || {NL} || '- ' || array_to_string(f.notes, {NL} || '- ') ELSE '' END AS source
  FROM drafts1 q LEFT JOIN matched m USING (doc_id, kb) LEFT JOIN fin f ON f.doc_id = m.doc_id AND f.chapter_idx = m.chapter_idx AND f.pos = m.pos),
ready AS (SELECT *, CASE WHEN kind = 5 THEN 'Frontmatter parse error: no front matter' WHEN source IS NULL THEN 'Could not find source section for chapter=' || chapter || ', pages=[' || pages[1] || ',' || pages[2] || ']' END AS error_message,
   CASE WHEN kind <> 5 AND source IS NOT NULL THEN '# Draft' || {NL} || {NL} || '```markdown' || {NL} || text || {NL} || '```' || {NL} || {NL} || '# Source text' || {NL} || {NL} || source || {NL} || {NL} || '# Task' || {NL} || {NL}
     || 'Check that the source text supports each claim of the draft: numbers, commands, product names and strong words above all. Answer with one JSON object.' || {NL} END AS prompt FROM prepared),
answered AS (SELECT *, CAST('0x' || substr(md5(prompt), 1, 8) AS BIGINT) AS h FROM ready),
checked AS (SELECT *, CASE WHEN error_message IS NOT NULL THEN 'ERROR' WHEN h % 3 <> 0 THEN 'PASS' ELSE 'FLAG' END AS decision,
   CASE WHEN error_message IS NULL AND h % 3 = 0 THEN CASE h % 7 % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'major' ELSE 'minor' END END AS severity FROM answered)
"""
)

# --- pages ---------------------------------------------------------------------------------------------

#: Page texts that reach every rule, read by Spark and DuckDB alike.
PAGE_TEXT = """CASE doc_id % 60 WHEN 5 THEN 'The Specifications and INFORMATION Regarding the Products' || chr(10) WHEN 6 THEN 'here Cisco and the Cisco logo are trademarks' || chr(10) WHEN 7 THEN 'Contents ' || chr(10)
 WHEN 8 THEN 'PREFACE  Preface  one' || chr(10) WHEN 9 THEN 'This preface includes the following sections' || chr(10) WHEN 10 THEN 'Reference Preface Map here' || chr(10) WHEN 11 THEN 'audience' || chr(10)
 WHEN 12 THEN 'now: This publication is for network administrators' || chr(10) WHEN 13 THEN 'Document Conventions' || chr(10) WHEN 14 THEN 'Documentation feedback' || chr(10) WHEN 15 THEN 'Related Documentation for Cisco Nexus 9' || chr(10)
 WHEN 16 THEN 'Communications, services, and additional information' || chr(10) WHEN 17 THEN 'Cisco Bug Search Tool' || chr(10) WHEN 18 THEN 'INDEX' || chr(10) WHEN 19 THEN 'I N D E X' || chr(10)
 WHEN 20 THEN 'CHAPTER 7' || chr(10) WHEN 21 THEN 'My  GUIDE' || chr(10) || '17' || chr(10) || 'xiv' || chr(10) || 'IN-12' || chr(10) WHEN 22 THEN 'A Header Of Sorts' || chr(10) || 'the line below it' || chr(10)
 WHEN 23 THEN 'Another Header' || chr(10) || 'This line follows.' || chr(10) WHEN 24 THEN 'contents of it' || chr(10) WHEN 25 THEN 'chapter 7' || chr(10) ELSE '' END || coalesce(text, '')"""

_PATTERNS = " ".join(f"WHEN regexp_matches(text, {_quoted('(?im)' + p)}) THEN {_quoted(why)}" for p, why in rules.PAGE_PATTERNS)
PAGES = rf"""
WITH p AS (SELECT doc_id // 100 AS doc_id, doc_id + 1 AS page_number, {PAGE_TEXT} AS text FROM documents WHERE doc_id IS NOT NULL),
m AS (SELECT *, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS size, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S'))) AS lines FROM p),
q AS (SELECT *, CASE WHEN page_number <= 2 THEN 'Cover or legal page (first two pages)' {_PATTERNS}
  WHEN size < 200 THEN 'Sparse content (' || size || ' chars)' WHEN lines <= 3 THEN 'Too few lines (' || lines || ')' END AS reason FROM m),
e AS (SELECT page_number, reason, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM q),
c AS (SELECT page_number, i, line, trim(line, ' ' || chr(9) || chr(13)) AS s FROM e WHERE reason IS NULL AND trim(line, ' ' || chr(9) || chr(13)) <> '' AND NOT regexp_matches(trim(line, ' ' || chr(9) || chr(13)), '^((?i:[ivxlcdm]+)|\d+|IN-\d+)$')
      AND lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) <> 'my guide'),
w AS (SELECT *, lead(line, 1) OVER o AS nxt FROM c WINDOW o AS (PARTITION BY page_number ORDER BY i)),
hints AS (SELECT page_number, count(*) AS n, string_agg(s, '|' ORDER BY i) AS headers FROM w
  WHERE length(s) BETWEEN 5 AND 80 AND regexp_matches(s, '^\p{{Lu}}') AND NOT ends_with(s, '.') AND (regexp_matches(nxt, '^\p{{Ll}}') OR regexp_matches(trim(nxt), '^(The |A |This )')) GROUP BY page_number),
t AS (SELECT q.doc_id, q.page_number, q.reason, coalesce(h.n, 0) AS n, coalesce(h.headers, '') AS headers,
             CASE WHEN q.reason IS NOT NULL THEN q.text ELSE coalesce((SELECT string_agg(line, chr(10) ORDER BY i) FROM c WHERE c.page_number = q.page_number), '') END AS text
      FROM q LEFT JOIN hints h USING (page_number)),
f AS (SELECT *, reason IS NULL AND regexp_matches(text, '(?m)^CHAPTER\s+\d+') AS has_chapter FROM t)
"""

LABELS = """WITH r AS (SELECT *, CASE WHEN toxic = 1 THEN 'FLAG' WHEN quality IS NULL THEN 'ERROR' ELSE 'PASS' END AS decision FROM labels)"""

_CALLS = """WITH a AS (SELECT conv_id, turn, coalesce(text, '') AS prompt, CAST('0x' || substr(md5(coalesce(text, '')), 1, 8) AS BIGINT) AS h FROM conversations)"""

SQL = {
    "page_boilerplate_reasons": PAGES + "SELECT reason, count(*) AS n, min(page_number) AS first_seen FROM q WHERE reason IS NOT NULL GROUP BY reason",
    "page_counts": PAGES + "SELECT count(*) AS total_pages, count(*) FILTER (reason IS NULL) AS content_pages, count(reason) AS boilerplate_pages, count(*) FILTER (n > 0) AS pages_with_headers, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_headers FROM f",
    "page_clean_lines": PAGES + r"""SELECT q.page_number, count(c.i) AS n_lines, CAST(coalesce(sum(len(regexp_extract_all(c.line, '[\p{L}\p{N}_]+'))), 0) AS BIGINT) AS n_words
        FROM q LEFT JOIN c USING (page_number) WHERE q.reason IS NULL GROUP BY q.page_number""",
    "page_flags": PAGES + "SELECT page_number, reason IS NOT NULL AS is_boilerplate, reason, has_chapter, n > 0 AS has_section, md5(text) AS text_md5 FROM f",
    "header_hints": PAGES + "SELECT page_number, n AS n_headers, headers FROM f WHERE n > 0",
    "line_explosion": PAGES + """, x AS (SELECT doc_id, page_number, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM f WHERE reason IS NULL)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, i) - 1 AS line_no, page_number, md5(text) AS text_md5 FROM x""",
    "page_scan": """SELECT 'book-' || doc_id // 100 AS document_title, CAST(row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS INT) AS page_number, md5(replace(coalesce(text, ''), chr(12), ' ')) AS text_md5 FROM documents WHERE doc_id IS NOT NULL""",
    "page_stream": PAGES + "SELECT page_number, reason, md5(text) AS text_md5 FROM f",
    "title_resolution": r"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR doc_id % 4 = 1 THEN 'file-' || doc_id WHEN trim(substr(coalesce(text, ''), 1, 30), ' ' || chr(9) || chr(10)) = '' THEN 'file-' || doc_id ELSE trim(substr(coalesce(text, ''), 1, 30), ' ' || chr(9) || chr(10)) END AS title
        FROM documents WHERE doc_id IS NOT NULL AND lower(trim(substr(coalesce(text, ''), 1, 30))) <> 'untitled'""",
    "extraction_reports": PAGES + """, one AS (SELECT *, '===== PAGE ' || page_number || ' =====' || CASE WHEN reason IS NOT NULL THEN ' ' || reason WHEN has_chapter THEN ' [CHAPTER START]' ELSE '' END || chr(10) || text || chr(10) AS part FROM f),
        per AS (SELECT doc_id, 'pages: ' || count(*) || chr(10) || 'content: ' || count(*) FILTER (reason IS NULL) || chr(10) || 'boilerplate: ' || count(reason) || chr(10) AS extraction,
                 coalesce(string_agg(part, chr(10) ORDER BY page_number) FILTER (reason IS NULL), '') AS content, coalesce(string_agg(part, chr(10) ORDER BY page_number) FILTER (reason IS NOT NULL), '') AS boilerplate FROM one GROUP BY doc_id)
        SELECT doc_id || '/extraction.txt' AS path, md5(extraction) AS content_md5 FROM per UNION ALL SELECT doc_id || '/content.txt', md5(content) FROM per UNION ALL SELECT doc_id || '/boilerplate.txt', md5(boilerplate) FROM per""",
    "chapter_starts": LINES + "SELECT doc_id, CAST(chapter_idx AS BIGINT) AS chapter_idx, chapter_number, chapter_title, ch_start, ch_end, page_start, page_end FROM ch",
    "chapter_toc": LINES + """SELECT ch.doc_id, chapter_number, md5(any_value(chapter_summary)) AS summary_md5, count(t.title) AS n_expected, md5(coalesce(string_agg(t.title, '|' ORDER BY t.i), '')) AS titles_md5
        FROM ch JOIN intro USING (doc_id, chapter_idx) LEFT JOIN toc t USING (doc_id, chapter_idx) GROUP BY ch.doc_id, chapter_number""",
    "section_anchors": LINES + "SELECT doc_id, CAST(chapter_idx AS BIGINT) AS chapter_idx, toc_idx, title, line_no FROM anchor",
    "detection_warnings": LINES + """SELECT doc_id, CAST(chapter_idx AS BIGINT) AS chapter_idx, CAST(-1 AS BIGINT) AS toc_idx, 'Chapter ' || chapter_number || ' (' || chapter_title || '): no contents entries' AS message FROM ch WHERE first_entry IS NULL
        UNION ALL SELECT a.doc_id, CAST(a.chapter_idx AS BIGINT), toc_idx, 'Chapter ' || chapter_number || ': section ''' || title || ''' not found' FROM anchor a JOIN ch USING (doc_id, chapter_idx) WHERE line_no IS NULL""",
    "h3_candidates": LINES + "SELECT doc_id, line_no, section_title, s AS title FROM x2 WHERE is_h3",
    "h3_shape": rf"""WITH v(i, s) AS (VALUES {", ".join(f"({i}, {_quoted(s)})" for i, s in enumerate(("Plain Header", "lower header", "Ends With Stop.", "Really?", "switch# show", "Switch(config)", "12.4 5", "step one", "Step One", "Example Of", "Procedure", "Table 4", "Tables", "• Point", "- Dash", "Xyz", "Four5", "ALLCAPS", "Word", "Über Den Wolken", "Figure 1 of it", "On page 3 of it", "This section", "This Sections", "Command or Action taken", "A router > prompt")))}),
        s AS (SELECT doc_id, i, s FROM documents JOIN v ON i = doc_id % 26 WHERE doc_id IS NOT NULL UNION ALL SELECT doc_id, -1, trim(substr(replace(coalesce(text, ''), chr(10), ' '), 1, 40)) FROM documents WHERE doc_id IS NOT NULL)
        SELECT doc_id, CAST(i AS INT) AS i, {_SHAPE} AS is_header FROM s""",
    "section_notes": LINES + "SELECT doc_id, line_no, note FROM notes",
    "section_stats": LINES + """SELECT doc_id, chapter_idx, pos, section_title, CAST(section_level AS BIGINT) AS section_level, parent_section, page_start, page_end,
        md5(content) AS content_md5, word_count, h3_count, len(notes) AS n_notes FROM sec""",
    "section_counts": LINES + """, s AS (SELECT doc_id, count(*) FILTER (section_level = 2) AS n_h2, count(*) FILTER (section_level = 3) AS n_h3, CAST(sum(len(notes)) AS BIGINT) AS n_notes FROM sec GROUP BY doc_id),
        wa AS (SELECT doc_id FROM anchor WHERE line_no IS NULL UNION ALL SELECT doc_id FROM ch WHERE first_entry IS NULL), wn AS (SELECT doc_id, count(*) AS n FROM wa GROUP BY doc_id), cn AS (SELECT doc_id, count(*) AS n_chapters FROM ch GROUP BY doc_id)
        SELECT cn.doc_id, n_chapters, coalesce(n_h2, 0) AS n_h2, coalesce(n_h3, 0) AS n_h3, coalesce(n_notes, 0) AS n_notes, coalesce(wn.n, 0) AS n_warnings FROM cn LEFT JOIN s USING (doc_id) LEFT JOIN wn USING (doc_id)""",
    "sections_json_round_trip": LINES + """SELECT 'Book ' || doc_id AS document_title, chapter_idx, pos, section_title, CAST(section_level AS INT) AS section_level, parent_section, page_start, page_end, md5(content) AS content_md5, md5(array_to_string(notes, '|')) AS notes_md5, word_count, h3_count, md5(chapter_summary) AS summary_md5 FROM sec""",
    "h3_merge": MERGED + "SELECT doc_id, chapter_idx, pos, parent_section, section_title, page_start, page_end, word_count, n_merged, len(notes) AS n_notes, md5(content) AS content_md5 FROM m",
    "h3_filter": MERGED + "SELECT doc_id, chapter_idx, pos, section_title, accepted, reason, word_count FROM dec",
    "h3_judgements": rf"""WITH v(i, t) AS (VALUES {", ".join(f"({i}, {_quoted(s)})" for i, s in enumerate(("Abc", "To-Do List Of It", "Use of it", "N9K-X9432PQ", "SAL1234AB", "sup-a+", "Manual power-on of Module", 'Service "x y" (PID 12) gone', "2024 Jan 3 10:11:12 switch", "Standby (failed)", "Loader Version", "Loader Version 9", "Related Topic", "12.4 - 5", "Plain Words Here", "Graceful Restartability", "Redundant Line Cards", "Modules", " Verifying It ", "Modular")))}),
        j AS (SELECT doc_id, t AS section_title, CASE WHEN doc_id % 3 = 0 THEN CAST(len(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_]+')) AS BIGINT) ELSE doc_id % 3 - 1 END AS word_count FROM documents JOIN v ON i = doc_id % 20 WHERE doc_id IS NOT NULL)
        SELECT doc_id, section_title, {ACCEPTED} AS accepted, {REASON} AS reason FROM j""",
    "h3_reason_histogram": MERGED + "SELECT reason, n, CAST(row_number() OVER (ORDER BY n DESC, first_seen) AS INT) AS place FROM (SELECT reason, count(*) AS n, min((doc_id, chapter_idx, pos)) AS first_seen FROM dec GROUP BY reason)",
    "h3_acceptance": MERGED + "SELECT count(*) AS total, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected, CASE WHEN count(*) = 0 THEN 0.0 ELSE count_if(accepted) / count(*) END AS acceptance_rate FROM dec",
    "kept_sections": MERGED + "SELECT doc_id, chapter_idx, pos, section_title, CAST(section_level AS BIGINT) AS section_level, CAST(h3_count AS BIGINT) AS h3_count, word_count, md5(content) AS content_md5 FROM fin",
    "decision_previews": MERGED + "SELECT doc_id, chapter_idx, pos, md5(replace(substr(trim(content, ' ' || chr(10)), 1, 80), chr(10), ' ')) AS preview_md5 FROM dec",
    "audit_file": MERGED + """, hd AS (SELECT *, (accepted, chapter_number, parent_section) IS DISTINCT FROM lag((accepted, chapter_number, parent_section)) OVER (PARTITION BY doc_id ORDER BY accepted, chapter_number, parent_section, section_title, pos) AS head FROM dec),
        hist AS (SELECT doc_id, string_agg('  ' || n || '  ' || reason, chr(10) ORDER BY n DESC, p) AS t FROM (SELECT doc_id, reason, count(*) AS n, min((chapter_idx, pos)) AS p FROM dec WHERE NOT accepted GROUP BY ALL) GROUP BY doc_id),
        body AS (SELECT doc_id, count(*) AS n, count(*) FILTER (accepted) AS a, string_agg(CASE WHEN head THEN chr(10) || CASE WHEN accepted THEN 'ACCEPTED' ELSE 'REJECTED' END || ' chapter ' || chapter_number || ' / ' || parent_section || chr(10) ELSE '' END || '  - ' || section_title || ': ' || reason, chr(10) ORDER BY accepted, chapter_number, parent_section, section_title, pos) AS t FROM hd GROUP BY doc_id)
        SELECT doc_id || '/rejected-h3s.txt' AS path, md5(printf('subsections: %d' || chr(10) || 'accepted: %d (%.1f%%)' || chr(10) || 'rejected: %d (%.1f%%)' || chr(10), n, a, a * 100.0 / n, n - a, (n - a) * 100.0 / n)
          || CASE WHEN hist.t IS NOT NULL THEN chr(10) || 'Reasons of rejection:' || chr(10) || hist.t || chr(10) ELSE '' END || body.t) AS content_md5 FROM body LEFT JOIN hist USING (doc_id)""",
    "section_files": LINES + rf"""SELECT printf('%d/sections/chapter-%d-%s/%02d-%s%s.md', doc_id, chapter_number, {SLUG.format(t="chapter_title")}, pos + 1, CASE WHEN section_level = 3 THEN 'h3-' ELSE '' END, {SLUG.format(t="section_title")}) AS path,
        md5('# ' || section_title || chr(10) || chr(10) || '> ' || coalesce(nullif(chapter_summary, ''), '(no introduction)') || chr(10) || chr(10) || coalesce(nullif(content, ''), '(no content)') || chr(10) || CASE WHEN len(notes) > 0 THEN chr(10) || '## Notes' || chr(10) || chr(10) || '- ' || array_to_string(notes, chr(10) || '- ') || chr(10) ELSE '' END) AS content_md5 FROM sec""",
    "generation_units": UNITS + "SELECT doc_id, chapter_idx, pos, sub, section_title, CAST(n_children AS BIGINT) AS n_children, total_words FROM v",
    "first_units": UNITS + "SELECT doc_id, chapter_idx, pos, sub, section_title FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chapter_idx, pos, sub) AS r FROM v) WHERE r <= 5",
    "unit_types": UNITS + "SELECT suggested_type, count(*) AS n FROM v GROUP BY suggested_type",
    "unit_prompts": UNITS + "SELECT doc_id, chapter_idx, pos, sub, page_range, length(prompt) AS prompt_chars, md5(prompt) AS prompt_md5 FROM asked",
    "skip_advice": UNITS + """SELECT doc_id, chapter_idx, pos, sub, CASE WHEN word_count < 50 THEN 'fewer than 50 words' END AS skip_advice FROM v""",
    "kb_parse": UNITS + "SELECT doc_id, chapter_idx, pos, sub, decision, kb_type, kb_filename, skip_reason, md5(kb_content) AS content_md5, CAST(NULL AS VARCHAR) AS error_message FROM made",
    "kb_names": UNITS + "SELECT doc_id, chapter_idx, pos, sub, file_name FROM named WHERE decision = 'generate'",
    "name_fold": """WITH RECURSIVE s AS (SELECT doc_id // 100 AS doc_id, doc_id AS seq, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS i,
          CASE doc_id % 6 WHEN 0 THEN 'a' WHEN 1 THEN 'a' WHEN 2 THEN 'a-2' WHEN 3 THEN 'a-b' WHEN 4 THEN 'untitled' ELSE 'a-2-2' END AS base FROM documents WHERE doc_id IS NOT NULL),
        f AS (SELECT DISTINCT doc_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS taken FROM s
          UNION ALL SELECT f.doc_id, s.i, s.seq, list_append(f.taken, CASE WHEN NOT list_contains(f.taken, s.base) THEN s.base ELSE s.base || '-' || list_filter(range(2, s.i + 3), lambda k: NOT list_contains(f.taken, s.base || '-' || k))[1] END) FROM f JOIN s ON s.doc_id = f.doc_id AND s.i = f.i + 1)
        SELECT doc_id, seq, taken[i] AS file_name FROM f WHERE i > 0""",
    "draft_exports": UNITS + f"""SELECT DISTINCT doc_id || '/kb-drafts/' || CASE WHEN decision = 'generate' THEN 'unverified/' || file_name ELSE 'skipped/' || {SLUG.format(t="section_title")} END || '.md' AS path,
        md5(CASE WHEN decision = 'generate' THEN kb_content ELSE '# ' || section_title || chr(10) || chr(10) || skip_reason END) AS content_md5 FROM named""",
    "debug_exports": UNITS + """SELECT doc_id || '/debug/llm-calls/' || chapter_idx || '-' || pos || '-' || sub || '.json' AS path, length(prompt) AS prompt_chars, decision, CAST(0 AS INT) AS retry_count FROM named""",
    "platform_override": """SELECT doc_id, md5('---' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'platform: ios-xe' || chr(10) END || 'id: nx-os-unit-' || doc_id || '-theory' || chr(10)
        || CASE WHEN doc_id % 2 = 0 THEN 'platform: ios-xe' || chr(10) ELSE '' END || '---' || chr(10) || coalesce(text, '')) AS draft_md5 FROM documents""",
    "response_parse": f"""WITH k AS (SELECT conv_id, turn, (conv_id + turn) % 9 AS k, coalesce(text, '') AS t FROM conversations)
        SELECT conv_id, turn, CASE WHEN k IN (0, 1, 2, 8) THEN 'generate' WHEN k = 3 THEN 'skip' ELSE 'error' END AS decision, CASE WHEN k IN (0, 2) THEN 'config' WHEN k IN (1, 8) THEN 'theory' END AS kb_type,
          CASE WHEN k IN (0, 1, 2, 8) THEN md5('---' || chr(10) || 'platform: nx-os' || chr(10) || 'id: x' || chr(10) || '---' || chr(10) || t) END AS content_md5,
          CASE k WHEN 4 THEN 'Parse error: {rules.NO_OBJECT}' WHEN 5 THEN 'Parse error: {rules.NOT_AN_OBJECT}' WHEN 6 THEN 'Parse error: {rules.BAD_DECISION}maybe' WHEN 7 THEN 'Parse error: Missing kb_content for generate decision' END AS error_message FROM k""",
    "verdict_parse": f"""WITH k AS (SELECT conv_id, turn, (conv_id + turn) % 7 AS k, coalesce(text, '') AS t FROM conversations)
        SELECT conv_id, turn, CASE WHEN k IN (0, 4) THEN 'PASS' WHEN k IN (1, 2) THEN 'FLAG' ELSE 'ERROR' END AS decision,
          CASE k WHEN 1 THEN md5('unknown|' || t || '||minor') WHEN 2 THEN md5('{rules.MALFORMED_CATEGORY}||' || t || '|minor;{rules.MALFORMED_CATEGORY}||{rules.BAD_PROBLEM}int|minor') ELSE md5('') END AS problems_md5,
          CASE k WHEN 3 THEN {_quoted('Parse error: ' + rules.NO_DECISION)} WHEN 5 THEN 'Parse error: problems is not a list' WHEN 6 THEN 'no such model' END AS error_message FROM k""",
    "model_calls": _CALLS + """SELECT conv_id, turn, h % 7 <> 0 AS success, CAST(CASE WHEN h % 7 = 0 THEN 3 ELSE 0 END AS INT) AS retry_count,
          CASE WHEN h % 7 <> 0 THEN '' WHEN h % 2 = 0 THEN 'empty response' ELSE 'timeout' END AS error, CASE WHEN h % 7 = 0 THEN '' ELSE 'answer ' || h END AS raw_text FROM a""",
    "model_payloads": """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'm' ELSE 'n' END AS model, md5(CASE WHEN turn % 2 = 0 THEN coalesce(text, '') ELSE '<|im_start|>system' || chr(10) || 'sys<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) END) AS prompt_md5,
          CAST(CASE WHEN turn % 2 = 0 THEN 2048 ELSE 4096 END AS INT) AS budget, CASE WHEN turn % 2 = 0 THEN 'json_object' END AS response_format, CAST(0.1 AS DOUBLE) AS temperature, CAST(0.9 AS DOUBLE) AS top_p FROM conversations""",
    "durations": """SELECT o_orderkey, printf('%dh %02dm %02ds', o_orderkey // 3600, o_orderkey % 3600 // 60, o_orderkey % 60) AS took FROM orders""",
    "kb_source_match": BOOK_DRAFTS + "SELECT doc_id, kb, chapter_idx, pos, how FROM matched",
    "kb_chapter_match": BOOK_DRAFTS + "SELECT doc_id, kb, chapter_idx FROM chosen",
    "kb_prepare": KB_DRAFTS + "SELECT doc_id, kb, section_title, error_message, md5(prompt) AS prompt_md5 FROM ready",
    "knowledge_base": KB_DRAFTS + "SELECT doc_id, kb, decision, severity, error_message FROM checked",
    "routed_exports": KB_DRAFTS + """, o AS (SELECT *, doc_id || '/kb-drafts/' || CASE decision WHEN 'PASS' THEN 'auto-approved' WHEN 'FLAG' THEN 'needs-review' ELSE 'verification-errors' END || '/' AS base FROM checked)
        SELECT base || kb AS path, md5(text) AS content_md5 FROM o UNION ALL
        SELECT base || substr(kb, 1, length(kb) - 3) || '.verification.md', md5('Decision: ' || decision || CASE WHEN decision = 'ERROR' THEN chr(10) || 'Error: ' || error_message WHEN decision = 'FLAG' THEN chr(10) || '- [' || severity || '] unsupported: c' || h % 97 || ' - not in source' ELSE '' END) FROM o""",
    "verification_routing": LABELS + "SELECT CASE decision WHEN 'PASS' THEN 'auto-approved' WHEN 'FLAG' THEN 'needs-review' ELSE 'verification-errors' END AS target, count(*) AS n FROM r GROUP BY 1",
    "verification_report": LABELS + """SELECT doc_id, 'Decision: ' || decision || CASE decision WHEN 'ERROR' THEN chr(10) || 'Error: no quality' WHEN 'FLAG' THEN chr(10) || '- [critical] c: x2 - y' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '- [major] c: x4 - y' ELSE '' END || chr(10) || '- [minor] c: x1 - y' || chr(10) || '- [minor] c: x5 - y'
          ELSE CASE WHEN quality = 0 THEN chr(10) || '- [minor] c: x - y' ELSE '' END END AS report FROM r""",
    "severity_counts": LABELS + """, p AS (SELECT unnest(CASE WHEN decision = 'FLAG' THEN CASE WHEN doc_id % 2 = 0 THEN ['minor', 'critical', 'major', 'minor'] ELSE ['minor', 'critical', 'minor'] END WHEN quality = 0 THEN ['minor'] ELSE [] END) AS severity FROM r)
        SELECT severity, count(*) AS n FROM p GROUP BY severity""",
    "per_document": LABELS + "SELECT doc_id // 100 AS doc_id, count(*) FILTER (decision = 'PASS') AS \"PASS\", count(*) FILTER (decision = 'FLAG') AS \"FLAG\", count(*) FILTER (decision = 'ERROR') AS \"ERROR\" FROM r GROUP BY 1",
    "front_matter": r"""WITH k AS (SELECT *, doc_id % 9 AS k FROM documents)
        SELECT doc_id, k < 5 OR k IS NULL AS ok, CASE k WHEN 5 THEN 'no front matter' WHEN 6 THEN 'malformed front matter' WHEN 7 THEN 'front matter is not a mapping' WHEN 8 THEN 'pages is not a list of numbers' END AS error,
          CASE WHEN k < 5 THEN 'unit ' || doc_id ELSE '' END AS want, CASE WHEN k < 5 THEN 'Chapter ' || doc_id % 7 END AS chapter, CASE WHEN k < 5 THEN doc_id + 1 END AS last_page, CASE WHEN k < 5 THEN md5(coalesce(text, '')) END AS body_md5 FROM k""",
    "draft_scan": r"""SELECT 'draft-' || doc_id || '.md' AS kb, md5('---' || chr(10) || 'id: d' || doc_id || chr(10) || '---' || chr(10) || coalesce(text, '')) AS text_md5 FROM documents WHERE doc_id IS NOT NULL AND doc_id % 50 = 0""",
    "unsupported_claims": """SELECT doc_id, '77.5' AS numbers, 'SUP-A' AS models, 'show inventory' AS commands, 'must' AS words FROM documents WHERE doc_id IS NOT NULL""",
    "heading_checks": """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Notes' WHEN 1 THEN 'Key Concepts,How It Works' ELSE 'Purpose,Procedure,Expected Output,Notes' END AS missing FROM documents WHERE doc_id IS NOT NULL""",
    "pipeline_stats": LABELS + """, g AS (SELECT count_if(role = 'user') AS a, count_if(role = 'assistant') AS b, count_if(role NOT IN ('user', 'assistant') OR role IS NULL) AS c FROM conversations),
        v AS (SELECT count_if(decision = 'PASS') AS p, count_if(decision = 'FLAG') AS f, count_if(decision = 'ERROR') AS e FROM r)
        SELECT CAST(a AS BIGINT) AS n_generate, CAST(b AS BIGINT) AS n_skip, CAST(c AS BIGINT) AS n_error, CAST(p AS BIGINT) AS n_pass, CAST(f AS BIGINT) AS n_flag, CAST(e AS BIGINT) AS n_verify_error,
               CASE WHEN a + b + c = 0 THEN 0.0 ELSE a / (a + b + c) END AS generation_rate, CASE WHEN p + f + e = 0 THEN 0.0 ELSE p / (p + f + e) END AS pass_rate FROM g, v""",
    "latencies": """SELECT CAST(sum(length(coalesce(text, ''))) / 8.0 AS DOUBLE) AS total_seconds, CAST(sum(length(coalesce(text, ''))) / 8.0 / count(*) AS DOUBLE) AS mean_seconds, CAST(sum(length(coalesce(text, ''))) / 8.0 / 16.0 AS DOUBLE) AS parallelism FROM conversations""",
    "throughput": r"""WITH t AS (SELECT turn % 2 AS batch, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+')) AS BIGINT) AS n FROM conversations), s AS (SELECT coalesce(sum(n) FILTER (batch = 0), 0) / 8.0 AS a, coalesce(sum(n) FILTER (batch = 1), 0) / 4.0 AS b FROM t)
        SELECT CAST(a AS DOUBLE) AS single_rate, CAST(b AS DOUBLE) AS batch_rate, CAST(CASE WHEN a = 0 THEN 0.0 ELSE b / a END AS DOUBLE) AS speedup FROM s""",
    "event_windows": """SELECT CAST(time_bucket(INTERVAL 5 MINUTES, ts) AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL""",
    "title_forms": r"""SELECT conv_id, turn, md5(coalesce(nullif(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled')) AS slug_md5,
        md5(lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')))) AS form_md5, len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+')) AS n_words FROM conversations""",
}
