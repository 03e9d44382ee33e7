"""DuckDB SQL that computes the queries' results another way, from the same tables."""

from __future__ import annotations

LINES = """lines AS (SELECT doc_id, seq, CAST((seq - 1) // 5 + 1 AS INTEGER) AS page_num, line AS text, CASE WHEN contains(line, ' | ') THEN 'table' ELSE 'paragraph' END AS type
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS seq FROM documents))"""
SIGNALS = """signals AS (SELECT doc_id, page_num, CAST(CASE WHEN (doc_id + page_num) % 7 = 0 THEN 0 WHEN (doc_id + page_num) % 5 = 0 THEN chars % 40 ELSE chars END AS INTEGER) AS char_count,
    CAST((doc_id * 3 + page_num) % 3 AS INTEGER) AS image_count, CASE WHEN (doc_id * 3 + page_num) % 3 > 0 THEN CAST((doc_id * 13 + page_num * 29) % 101 AS DOUBLE) / 100 ELSE CAST(0 AS DOUBLE) END AS image_coverage,
    CAST((doc_id * 7 + page_num * 43) % 260 AS INTEGER) AS drawing_count FROM (SELECT doc_id, page_num, CAST(sum(length(text)) AS BIGINT) AS chars FROM lines GROUP BY 1, 2))"""
HYBRID = """hybrid AS (SELECT *, image_count > 0 AS has_image, CASE WHEN char_count = 0 AND image_count > 0 THEN 'no_native_text_with_image' WHEN char_count < 30 AND image_count > 0 AND image_coverage >= 0.03 THEN 'low_text_with_image'
    WHEN char_count < 150 AND image_count > 0 AND image_coverage >= 0.5 THEN 'image_dominant_low_text' ELSE 'native_text_available' END AS why FROM signals)"""
ROUTED = """routed AS (SELECT doc_id, page_num, char_count, has_image, image_coverage, drawing_count, image_count, CASE WHEN direct THEN 'vlm' WHEN why = 'native_text_available' THEN 'native' ELSE 'ocr' END AS mode,
    CASE WHEN direct THEN 'vector_only_no_native_text' ELSE why END AS reason,
    list_filter([CASE WHEN direct THEN 'vector_only_no_native_text' END, CASE WHEN image_coverage >= 0.5 THEN 'high_image_coverage' END, CASE WHEN drawing_count >= 20 AND char_count < 150 THEN 'drawing_dominant_low_text' END], lambda x: x IS NOT NULL) AS candidate_reasons
    FROM (SELECT *, char_count = 0 AND NOT has_image AND drawing_count >= 200 AS direct FROM hybrid))"""
STATS = """touched AS (SELECT doc_id, CASE WHEN type = 'table' THEN 'table' WHEN seq % 9 = 0 THEN 'picture' ELSE 'text' END AS kind, length(trim(text)) AS chars, unnest(CASE WHEN seq % 5 = 0 THEN [page_num, page_num + 1] ELSE [page_num] END) AS page_num FROM lines),
  stats AS (SELECT s.doc_id, s.page_num, CAST(coalesce(sum(CASE WHEN kind = 'text' THEN chars ELSE 0 END), 0) AS BIGINT) AS text_chars, count(*) FILTER (kind = 'text') AS text_element_count, count(*) FILTER (kind = 'table') AS table_count, count(*) FILTER (kind = 'picture') AS picture_count
    FROM signals s LEFT JOIN touched t ON t.doc_id = s.doc_id AND t.page_num = s.page_num GROUP BY 1, 2)"""
DECIDED = """decided AS (SELECT doc_id, page_num, mode AS initial_route, CASE WHEN mode = 'vlm' THEN 'vlm_direct' ELSE mode END AS final_route, mode <> 'vlm' AND len(reasons) = 0 AS accepted, reasons, text_chars
    FROM (SELECT r.*, text_chars, CASE WHEN mode = 'vlm' THEN candidate_reasons WHEN page_num IN (FORCED) THEN ['forced_vlm_page'] ELSE list_filter([CASE WHEN text_element_count = 0 AND table_count = 0 THEN 'no_docling_content' END,
      CASE WHEN len(candidate_reasons) > 0 AND text_chars < 80 THEN 'visual_risk_with_sparse_extraction' END, CASE WHEN mode = 'ocr' AND char_count = 0 AND text_chars = 0 THEN 'ocr_produced_no_text' END], lambda x: x IS NOT NULL) END AS reasons FROM routed r JOIN stats USING (doc_id, page_num)))"""
BUDGETED = """placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, accepted ORDER BY page_num) AS place FROM decided),
  budgeted AS (SELECT doc_id, page_num, initial_route, NOT accepted AND place > 2 AS over_budget, CASE WHEN accepted THEN 'accept' WHEN place > 2 THEN 'manual_review' ELSE 'fallback_to_vlm' END AS decision, CASE WHEN NOT accepted AND place > 2 THEN 'manual_review' ELSE final_route END AS final_route,
    CASE WHEN NOT accepted AND place > 2 THEN list_append(reasons, 'max_vlm_pages_exceeded') ELSE reasons END AS reasons FROM placed)"""
OUTLINE = """titled AS (SELECT doc_id, source || '-' || doc_id AS title, CAST((len(string_split(text, chr(10))) - 1) // 5 + 2 AS INTEGER) AS page_count FROM documents),
  outline AS (SELECT doc_id, page_num AS ord, CAST(page_num % 2 + 1 AS INTEGER) AS outline_level, CAST(page_num + doc_id % 2 AS INTEGER) AS page, trim(CASE (page_num - 1) % 5 WHEN 0 THEN 'PART ' || ['I','II','III','IV','V','VI','VII','VIII','IX','X'][((page_num - 1) // 5) % 10 + 1] || ' ' || text
    WHEN 1 THEN page_num || '. ' || text WHEN 2 THEN 'Appendix IV: ' || text WHEN 3 THEN 'Appendices' ELSE text END) AS title FROM lines WHERE seq % 5 = 1)"""
SLUG = "CASE WHEN {s} = '' THEN 'untitled' ELSE {s} END"


def slug(expression: str) -> str:
    inner = f"trim(substring(trim(regexp_replace(lower({expression}), '[^a-z0-9]+', '_', 'g'), '_'), 1, 48), '_')"
    return SLUG.format(s=inner)


KINDS = f"""kinds AS (SELECT o.*, CASE WHEN (ord - 1) % 5 = 0 THEN 'part' WHEN (ord - 1) % 5 = 3 THEN 'appendices' WHEN (ord - 1) % 5 = 2 THEN 'appendix' WHEN (ord - 1) % 5 = 1 THEN 'chapter' ELSE 'section' END AS kind FROM outline o),
  leveled AS (SELECT *, CASE WHEN kind IN ('part', 'appendices') THEN 1 ELSE 2 END AS level, (SELECT count(*) FROM kinds e WHERE e.doc_id = k.doc_id AND e.kind = k.kind AND e.ord <= k.ord) AS nth, ((ord - 1) // 5) % 10 + 1 AS numeral FROM kinds k),
  named AS (SELECT l.doc_id, l.ord, l.title, l.kind, CAST(l.level AS INTEGER) AS level, l.outline_level, greatest(1, least(l.page, t.page_count)) AS start_page, t.page_count, t.title AS root_title,
    CASE l.kind WHEN 'part' THEN 'part_' || printf('%02d', numeral) || '_' || {slug('l.title')} WHEN 'chapter' THEN 'ch_' || printf('%03d', l.ord) || '_' || {slug("regexp_extract(l.title, '^([0-9]+)[.] +(.+)', 2)")} WHEN 'appendix' THEN 'app_04_' || {slug("substring(l.title, 14)")}
      WHEN 'appendices' THEN 'appendices' ELSE 'section_' || printf('%03d', l.nth) || '_' || {slug('l.title')} END AS section_id FROM leveled l JOIN titled t USING (doc_id))"""
TREE = """fronts AS (SELECT doc_id, 0 AS ord, 'Front Matter Before PDF Outline' AS title, 'front_matter' AS kind, CAST(1 AS INTEGER) AS level, CAST(0 AS INTEGER) AS outline_level, CAST(1 AS INTEGER) AS start_page, page_count, root_title, 'front_matter_pre_outline' AS section_id, true AS front FROM named WHERE ord = 1 AND start_page > 1),
  nodes AS (SELECT *, false AS front FROM named UNION ALL SELECT * FROM fronts),
  tree AS (SELECT n.*, coalesce((SELECT CASE WHEN count(*) > 0 THEN greatest(n.start_page, arg_min(b.start_page, b.ord) - 1) END FROM nodes b WHERE b.doc_id = n.doc_id AND b.ord > n.ord AND b.level <= n.level), n.page_count) AS end_page,
    (SELECT arg_max(struct_pack(i := b.section_id, t := b.title), b.ord) FROM nodes b WHERE b.doc_id = n.doc_id AND b.ord < n.ord AND b.level < n.level AND NOT b.front) AS up FROM nodes n),
  sections AS (SELECT doc_id, section_id, title, level, CASE WHEN up IS NULL THEN 'document' ELSE up.i END AS parent_id, CASE WHEN up IS NULL THEN root_title ELSE up.t END AS parent_title, start_page, CAST(end_page AS INTEGER) AS end_page, CASE WHEN front THEN 'synthetic_pre_outline' ELSE 'pdf_outline' END AS source,
      CAST(CASE WHEN front THEN 1 WHEN outline_level = level THEN 0.98 ELSE 0.9 END AS DOUBLE) AS confidence, outline_level, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS INTEGER) AS "order", kind FROM tree
    UNION ALL SELECT doc_id, 'document', title, 0, NULL, NULL, 1, page_count, 'synthetic_root', CAST(1 AS DOUBLE), 0, 0, 'document' FROM titled)"""
UNITS = """units AS (SELECT doc_id, seq, page_num, CASE WHEN type = 'table' THEN CASE WHEN trim(text) <> '' THEN 'Table Caption: ' || trim(text) || chr(10) ELSE '' END || array_to_string(list_transform(string_split(text, ' | '), lambda c: replace(trim(c), '|', chr(92) || '|')), ' | ') ELSE trim(text) END AS text FROM lines),
  counted AS (SELECT *, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS tokens, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS n FROM units WHERE trim(text) <> '')"""
PACK = """pack AS (SELECT doc_id, seq, n, text, page_num, tokens, tokens AS held, CAST(1 AS BIGINT) AS chunk_no FROM counted WHERE n = 1
    UNION ALL SELECT c.doc_id, c.seq, c.n, c.text, c.page_num, c.tokens, CASE WHEN p.held > 0 AND p.held + c.tokens > 200 THEN c.tokens ELSE p.held + c.tokens END, p.chunk_no + CASE WHEN p.held > 0 AND p.held + c.tokens > 200 THEN 1 ELSE 0 END FROM pack p JOIN counted c ON c.doc_id = p.doc_id AND c.n = p.n + 1)"""
CHUNKS = """chunked AS (SELECT doc_id, chunk_no, string_agg(text, chr(10) || chr(10) ORDER BY seq) AS text, array_to_string(list_sort(list_distinct(list(page_num))), ',') AS pages, CAST(sum(tokens) AS BIGINT) AS token_count FROM pack GROUP BY 1, 2)"""
HEADINGS = """headings AS (SELECT doc_id, seq AS ord, CAST((seq * 7 + doc_id) % 20 + 1 AS INTEGER) AS level, trim(text) AS title, page_num AS page FROM lines)"""
BLOCKS = """blocks AS (SELECT doc_id, page_num, seq AS idx, text, CAST(CASE WHEN seq % 6 = 1 THEN 14 + doc_id % 3 WHEN seq % 6 = 4 THEN 8 ELSE 10 + seq % 2 END AS DOUBLE) AS size FROM lines),
  sizes AS (SELECT doc_id, size, sum(length(text)) AS chars, min(page_num * 1000000 + idx) AS first FROM blocks GROUP BY 1, 2),
  bodies AS (SELECT doc_id, arg_max(size, chars * 1000000000000 - first) AS body_size FROM sizes GROUP BY 1),
  ranks AS (SELECT doc_id, size, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY size DESC) AS INTEGER) AS level FROM (SELECT DISTINCT doc_id, size FROM blocks JOIN bodies USING (doc_id) WHERE size >= body_size * 1.15 AND length(trim(text)) >= 4))"""
FLAWED = """base AS (SELECT doc_id, seq, CASE WHEN seq % 11 <> 0 THEN page_num - CASE WHEN seq % 6 = 0 THEN 1 ELSE 0 END END AS page_num, type, CASE WHEN seq % 19 <> 0 THEN 'e' || printf('%05d', seq) END AS element_id, CASE WHEN seq % 13 = 0 THEN '' ELSE 'document' END AS section_id, CASE WHEN seq % 17 <> 0 THEN 'docling' END AS source_parser,
    CASE WHEN type = 'table' THEN 'Caption' WHEN seq % 3 = 0 THEN CASE WHEN seq % 15 = 0 THEN 'http://longword' ELSE 'longword' END || 'Joined' || CASE WHEN seq % 2 = 0 THEN 'abc' ELSE 'xyzq' END || ' ' || text ELSE text END AS text, CASE WHEN type = 'table' THEN string_split(text, ' | ') END AS cells FROM lines),
  flawed AS (SELECT * FROM base UNION ALL SELECT doc_id, seq + 100000, page_num, 'text', 'c' || coalesce(element_id, 'x'), section_id, source_parser, array_to_string(cells[1:4], ' '), NULL FROM base WHERE cells IS NOT NULL)"""
GATES = """provenance AS (SELECT doc_id, 'provenance_issues' AS "check", message FROM (SELECT doc_id, unnest(CASE WHEN element_id IS NULL THEN ['Element found without an element_id.'] ELSE [CASE WHEN coalesce(page_num, 0) = 0 THEN 'Element ' || element_id || ' is missing page_num.' END, CASE WHEN section_id = '' THEN 'Element ' || element_id || ' is missing section_id.' END, CASE WHEN source_parser IS NULL THEN 'Element ' || element_id || ' is missing source_parser metadata.' END] END) AS message FROM flawed) WHERE message IS NOT NULL),
  words AS (SELECT doc_id, seq, element_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM flawed),
  joins AS (SELECT doc_id, 'text_reconstruction_issues' AS "check", 'Element ' || coalesce(element_id, 'None') || ' contains potential word-join artifact: ''' || word || '''' AS message FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq, i) AS place FROM words WHERE regexp_matches(word, '[a-z]+[A-Z][a-z]+') AND length(word) > 12 AND NOT contains(word, 'http') AND NOT contains(word, '/')) WHERE place <= 5),
  doubles AS (SELECT t.doc_id, 'table_duplication_issues' AS "check", 'Potential table content duplicated in text element ' || coalesce(x.element_id, 'None') || ' near table ' || coalesce(t.element_id, 'None') AS message FROM flawed t JOIN flawed x ON x.doc_id = t.doc_id AND x.page_num IS NOT DISTINCT FROM t.page_num AND x.type IN ('paragraph', 'text') AND length(x.text) > 20 AND contains(array_to_string(t.cells, ' '), x.text) WHERE t.cells IS NOT NULL),
  turns AS (SELECT e.doc_id, 'reading_order_issues' AS "check", 'Reading order violation: Element ' || coalesce(element_id, 'None') || ' is on page ' || page_num || ' but previous element was on page ' || high || '.' AS message FROM (SELECT a.doc_id, a.seq, a.element_id, a.page_num, max(CASE WHEN a.page_num > 0 THEN a.page_num END) OVER (PARTITION BY a.doc_id ORDER BY a.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM flawed a) e WHERE page_num > 0 AND page_num < high)"""


def with_(*parts: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n  ".join(parts) + "\n" + select
