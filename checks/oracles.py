"""The SQL side: the same results from line-by-line windows, for DuckDB."""

from __future__ import annotations

from checks import fixtures as fx
from checks.inputs import FILES_SQL, PAGES_SQL, WS_RE2, noisy_sql, sql_timecode, subtitle_files_sql, texts_sql, tracks_sql, words_sql

LF = "chr(10)"
TIME = r"\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2},\p{Nd}{3}"
ARROW = rf"{WS_RE2}*-->{WS_RE2}*"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_RE2}+|{WS_RE2}+$', '', 'g')"


def _split_rows(expr: str, name: str, pos: str) -> str:
    return f"unnest({expr}) AS {name}, generate_subscripts({expr}, 1) - 1 AS {pos}"


EDITS = [
    ("bullet", rf"regexp_replace({{x}}, '^[•\-*]{WS_RE2}*', '')"),
    ("numbering", rf"regexp_replace({{x}}, '^[A-Z0-9]+\.{WS_RE2}*', '')"),
    ("brackets", r"regexp_replace({x}, '\[.*?\]', '', 'g')"),
    ("handles", r"regexp_replace({x}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"),
    ("urls", rf"regexp_replace({{x}}, 'https?://[^{WS_RE2[1:-1]}]+', '', 'g')"),
    ("ampersand", "replace({x}, '&', ' and ')"),
    ("greater_than", "replace({x}, '>', ' greater than ')"),
    ("less_than", "replace({x}, '<', ' less than ')"),
    ("arrow", "replace({x}, '->', ' leads to ')"),
    ("positive", rf"regexp_replace({{x}}, '\+{WS_RE2}*ve', 'positive', 'g')"),
    ("negative", rf"regexp_replace({{x}}, '-{WS_RE2}*ve', 'negative', 'g')"),
    (
        "collapse",
        rf"regexp_replace(regexp_replace({{x}}, '{WS_RE2}+', ' ', 'g'), '^ | $', '', 'g')",
    ),
]


def _edit_sql() -> str:
    columns, x = [], "s"
    for name, rule in EDITS:
        call = rule.replace("{x}", x).replace("{{", "{").replace("}}", "}")
        columns.append(f"{call} AS e_{name}")
        x = f"e_{name}"
    return ", ".join(columns)


def lines_ctes(source: str) -> str:
    unified = f"replace(replace(text, chr(13) || {LF}, {LF}), chr(13), {LF})"
    return rf"""
    src AS (SELECT * FROM {source}),
    raw AS (SELECT doc_id, {_split_rows("ls", "rline", "rpos")}
            FROM (SELECT doc_id, string_split({unified}, {LF}) AS ls FROM src)),
    tagged AS (SELECT doc_id, rpos, s, CASE
                 WHEN s = '' THEN 'empty'
                 WHEN regexp_matches(s, '^\p{{Nd}}{{1,3}}$') THEN 'page_number'
                 WHEN regexp_matches(s, '^Chapter \p{{Nd}}+:$') THEN 'chapter_header'
                 WHEN regexp_matches(s, '^[_\-=]{{3,}}$') THEN 'separator' END AS why
               FROM (SELECT doc_id, rpos, {_strip("rline")} AS s FROM raw)),
    edited AS (SELECT doc_id, rpos, s, {_edit_sql()} FROM tagged WHERE why IS NULL),
    cleaned AS (SELECT doc_id, e_collapse AS line,
                       row_number() OVER (PARTITION BY doc_id ORDER BY rpos) - 1 AS pos
                FROM edited WHERE e_collapse <> ''),
    marked AS (SELECT doc_id, pos, line, coalesce(sum(CASE WHEN regexp_matches(line, '[.!?)]$')
                      THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS para_no
               FROM cleaned),
    joined AS (SELECT doc_id, para_no, string_agg(line, ' ' ORDER BY pos) AS para
               FROM marked GROUP BY doc_id, para_no),
    kept AS (SELECT * FROM joined WHERE length(para) >= 10 AND NOT contains(para, 'Copyright')
             AND NOT contains(para, 'All Rights Reserved')),
    norm AS (SELECT src.doc_id,
                    coalesce(string_agg(para, {LF} || {LF} ORDER BY para_no), '') AS text
             FROM src LEFT JOIN kept ON src.doc_id = kept.doc_id GROUP BY src.doc_id)"""


def sentence_ctes(source: str, table: str = "norm") -> str:
    return rf"""{source},
    pieces AS (SELECT doc_id, {_split_rows("ps", "p", "i")}
               FROM (SELECT doc_id, string_split_regex(text, '\.(?:{WS_RE2}+|$)') AS ps
                     FROM {table})),
    sents AS (SELECT doc_id, s AS sentence,
                     row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS n
              FROM (SELECT doc_id, i, {_strip("p")} AS s FROM pieces) WHERE s <> '')"""


def utterance_ctes(source: str, size: int) -> str:
    return f"""{sentence_ctes(lines_ctes(source))},
    utts AS (SELECT doc_id, utt_no, printf('sentence_%04d.txt', utt_no) AS utt_name, content
             FROM (SELECT doc_id, n // {size} + 1 AS utt_no,
                          string_agg(sentence, '. ' ORDER BY n) || '.' AS content
                   FROM sents GROUP BY doc_id, n // {size}))"""


def manifest_ctes(source: str, size: int) -> str:
    return f"""{utterance_ctes(source, size)},
    manifest AS (SELECT doc_id, CAST(utt_no AS BIGINT) AS utt_no,
        doc_id || '/' || replace(utt_name, '.txt', '') AS utt_id, utt_name AS file,
        {_strip("content")} AS text, 'ta-IN-PallaviNeural' AS voice, '+0%' AS rate,
        '+0Hz' AS pitch, '+0%' AS volume, replace(utt_name, '.txt', '.mp3') AS audio_name,
        CAST(NULL AS VARCHAR) AS subtitle_name, CAST(NULL AS VARCHAR) AS error FROM utts)"""


def outcome_ctes(source: str) -> str:
    r = "(doc_id * 31 + utt_no) % 7"
    return f"""{manifest_ctes(source, 1)},
    outs AS (SELECT doc_id, utt_no, utt_id, file,
        CASE WHEN {r} > 1 THEN 'mp3/' || doc_id || '/' || audio_name END AS audio,
        CASE WHEN {r} > 1 AND {r} % 2 = 0
             THEN 'mp3/' || doc_id || '/' || replace(audio_name, '.mp3', '.srt') END AS subtitle,
        CASE {r} WHEN 0 THEN 'No outcome was reported.' WHEN 1 THEN 'No audio was received.' END
            AS error FROM manifest)"""


DETECTED = rf"regexp_matches(content, '(?m)^\p{{Nd}}+{WS_RE2}*\n{TIME}{ARROW}{TIME}')"


def _ms(code: str) -> str:
    part = "CAST(substr({c}, {a}, {n}) AS BIGINT)"
    p = [part.format(c=code, a=a, n=n) for a, n in ((1, 2), (4, 2), (7, 2), (10, 3))]
    return f"({p[0]} * 3600000 + {p[1]} * 60000 + {p[2]} * 1000 + {p[3]})"


def cue_ctes() -> str:
    codes = f"({TIME}){ARROW}({TIME})"
    return rf"""
    files AS (SELECT * FROM {subtitle_files_sql()}),
    routed AS (SELECT doc_id, content FROM files WHERE {DETECTED}),
    ln AS (SELECT doc_id, {_split_rows("ls", "line", "pos")}
           FROM (SELECT doc_id, string_split(content, {LF}) AS ls FROM routed)),
    blocks AS (SELECT *, sum(CASE WHEN t = '' THEN 1 ELSE 0 END)
                         OVER (PARTITION BY doc_id ORDER BY pos) AS blk
               FROM (SELECT *, {_strip("line")} AS t FROM ln)),
    pairs AS (SELECT *, lead(line) OVER (PARTITION BY doc_id, blk ORDER BY pos) AS nxt
              FROM blocks WHERE t <> ''),
    heads AS (SELECT doc_id, blk, min(pos) AS hpos, min_by(nxt, pos) AS times FROM pairs
              WHERE regexp_matches(t, '^\p{{Nd}}+$') AND regexp_matches(nxt, '{codes}')
              GROUP BY doc_id, blk),
    cues AS (SELECT h.doc_id, row_number() OVER (PARTITION BY h.doc_id ORDER BY h.hpos) AS cue_no,
                    {_ms(f"regexp_extract(any_value(h.times), '{codes}', 1)")} AS start_ms,
                    {_ms(f"regexp_extract(any_value(h.times), '{codes}', 2)")} AS end_ms,
                    {_strip("coalesce(string_agg(p.line, ' ' ORDER BY p.pos), '')")} AS text
             FROM heads h LEFT JOIN pairs p
               ON p.doc_id = h.doc_id AND p.blk = h.blk AND p.pos > h.hpos + 1
             GROUP BY h.doc_id, h.blk, h.hpos)"""


def break_ctes() -> str:
    return rf"""
    words AS (SELECT * FROM {words_sql()}),
    timed AS (SELECT *, CAST(offset_ticks AS DOUBLE) / 10000 AS start_ms,
                     CAST(offset_ticks AS DOUBLE) / 10000
                     + CAST(duration_ticks AS DOUBLE) / 10000 AS end_ms FROM words),
    hard AS (SELECT *, (regexp_matches(word, '[.!?:;,]$') OR nxt IS NULL OR nxt - end_ms > 300)
                       AS is_hard
             FROM (SELECT *, lead(start_ms) OVER (PARTITION BY utt_id ORDER BY seq) AS nxt
                   FROM timed)),
    islands AS (SELECT *, coalesce(sum(CAST(is_hard AS INT)) OVER (PARTITION BY utt_id ORDER BY seq
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM hard),
    places AS (SELECT *, row_number() OVER (PARTITION BY utt_id, island ORDER BY seq) AS place
               FROM islands),
    broken AS (SELECT *, (is_hard OR place % 5 = 0) AS is_break FROM places),
    numbered AS (SELECT *, coalesce(sum(CAST(is_break AS INT)) OVER (PARTITION BY utt_id
                        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                        AS phrase_no FROM broken),
    phrases AS (SELECT utt_id, CAST(phrase_no AS BIGINT) AS phrase_no, min(start_ms) AS start_ms,
                   CAST(max_by(offset_ticks + duration_ticks, seq) AS DOUBLE) / 10000 AS end_ms,
                   {_strip("regexp_replace(string_agg(word, ' ' ORDER BY seq), ' +([.,!?:;])', '\\1', 'g')")}
                       AS text
                FROM numbered GROUP BY utt_id, phrase_no)"""


def timeline_ctes() -> str:
    digits = r"regexp_extract(file_name, '([0-9௦-௯]+)', 1)"
    ascii_form = f"translate({digits}, '௦௧௨௩௪௫௬௭௮௯', '0123456789')"
    order = (
        "ORDER BY CASE WHEN d = '' THEN 1 ELSE 0 END, CAST(nullif(d, '') AS DECIMAL(38, 0)), "
        "file_name"
    )
    return f"""
    tracks AS (SELECT *, {ascii_form} AS d FROM {tracks_sql()}),
    timeline AS (SELECT album_id, file_name, CAST(CAST(nullif(d, '') AS DECIMAL(38, 0)) AS VARCHAR) AS digits,
          TRY_CAST(nullif(d, '') AS BIGINT) AS number,
          row_number() OVER (PARTITION BY album_id {order}) AS position, duration_ms,
          CAST(coalesce(sum(duration_ms + 500) OVER (PARTITION BY album_id {order}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms
          FROM tracks)"""


def batch_ctes() -> str:
    unread = "'Failed to process file: ' || file_name"
    return f"""{cue_ctes()},
    listed AS (SELECT doc_id, file_name AS path, content, {DETECTED} AS is_srt,
        CASE WHEN doc_id % 17 = 3 THEN {unread}
             WHEN doc_id % 13 = 4 OR {_strip("content")} = '' THEN 'Please enter text to convert.'
             END AS failed FROM files),
    requests AS (
        SELECT doc_id, path, 'error' AS kind, 0 AS cue_no, CAST(NULL AS BIGINT) AS start_ms,
               CAST(NULL AS BIGINT) AS end_ms, NULL AS text, failed AS error
        FROM listed WHERE failed IS NOT NULL
        UNION ALL SELECT doc_id, path, 'prose', 0, NULL, NULL, {_strip("content")}, NULL
        FROM listed WHERE failed IS NULL AND NOT is_srt
        UNION ALL SELECT l.doc_id, path, 'cue', cue_no, start_ms, end_ms, text, NULL
        FROM listed l JOIN cues c ON l.doc_id = c.doc_id WHERE failed IS NULL AND text <> '')"""


def wide(sql: str, *columns: str) -> str:
    """Integer columns as BIGINT, as the Spark side has them."""
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
    return sql.replace("@@", casts)


def all_sql() -> dict[str, str]:
    src = texts_sql()
    lines = f"WITH {lines_ctes(src)}"
    cues = f"WITH {cue_ctes()}"
    words = f"WITH {break_ctes()}"
    outs = f"WITH {outcome_ctes(src)}"
    cue_failed = "(doc_id * 13 + cue_no) % 6 = 1"
    drops = ["empty", "page_number", "chapter_header", "separator"]
    manifest_columns = (
        "doc_id, utt_no, utt_id, file, text, voice, rate, pitch, volume, audio_name, "
        "subtitle_name, error"
    )
    paths = f"(SELECT url AS path FROM pages UNION ALL SELECT path FROM {fx.sql_values([(p,) for p in fx.PATHS], 'path')})"
    doc_path = "lang || '/' || source || '/' || doc_id || '.txt'"
    blank_pages = f"""(SELECT doc_id, page_no + 1 AS utt_no,
        CASE WHEN (doc_id + page_no) % 5 = 0 THEN {fx.sql_text(chr(10) + " " + chr(0x3000))}
             ELSE coalesce(text, '') END AS content FROM {PAGES_SQL})"""
    rendered = (
        f"cue_no || {LF} || {sql_timecode('start_ms')} || ' --> ' || {sql_timecode('end_ms')} "
        f"|| {LF} || text || {LF} || {LF}"
    )
    phrase_block = (
        f"(phrase_no + 1) || {LF} || {sql_timecode('trunc(start_ms)')} || ' --> ' || "
        f"{sql_timecode('trunc(end_ms)')} || {LF} || text || {LF} || {LF}"
    )
    hits = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(count(*) FILTER (WHERE {before} <> e_{name}) AS BIGINT) "
        "AS lines FROM edited"
        for before, (name, _) in zip(["s"] + [f"e_{n}" for n, _ in EDITS], EDITS)
    )
    times = (
        "(SELECT doc_id, utt_no, CAST(utt_no * 100003 + doc_id % 1000 AS BIGINT) AS ms FROM "
        f"(WITH {utterance_ctes(src, 1)} SELECT * FROM utts))"
    )
    batch_report = f"""WITH {batch_ctes()},
            judged AS (SELECT *, CASE (doc_id * 13 + cue_no) % 6 WHEN 1 THEN 'No audio was received.'
                WHEN 3 THEN 'No outcome was reported.' END AS bad FROM requests),
            counted AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'cue') AS requested,
                count(bad) FILTER (WHERE kind = 'cue') AS skipped,
                max(coalesce(error, bad)) FILTER (WHERE kind <> 'cue') AS error
                FROM judged GROUP BY doc_id)
            SELECT l.doc_id, path, CAST(coalesce(requested, 0) AS BIGINT) AS requested,
            CAST(coalesce(skipped, 0) AS BIGINT) AS skipped,
            CASE WHEN error IS NULL THEN 'mp3/' || regexp_replace(path, '[.][^.]*$', '') || '.mp3' END AS audio,
            CASE WHEN error IS NULL THEN 'mp3/' || regexp_replace(path, '[.][^.]*$', '') || '.srt' END AS subtitle,
            error FROM listed l LEFT JOIN counted c ON l.doc_id = c.doc_id"""
    page_texts = (
        f"(SELECT conv_id AS doc_id, string_agg(coalesce(text, '') || {LF}, '' ORDER BY turn) AS text "
        "FROM conversations GROUP BY conv_id)"
    )
    return {
        "work_list_union": f"""
            SELECT CAST(0 AS BIGINT) AS origin, {doc_path} AS path FROM documents
            WHERE doc_id IN (SELECT doc_id FROM labels)
            UNION ALL SELECT CAST(1 AS BIGINT) AS origin, {doc_path} AS path FROM documents""",
        "file_identity": rf"""
            SELECT path, CASE WHEN dotted THEN regexp_extract(f, '^(.*)\.[^.]*$', 1) ELSE f END
                       AS base_name,
                   CASE WHEN dotted THEN lower(regexp_extract(f, '(\.[^.]*)$', 1)) ELSE '' END
                       AS extension
            FROM (SELECT path, f, regexp_matches(f, '[^.].*\.[^.]*$') AS dotted
                  FROM (SELECT path, string_split(path, '/')[-1] AS f FROM {paths}))""",
        "undecodable_rows": f"""
            SELECT path, CASE WHEN bad THEN NULL ELSE text END AS text,
                   CASE WHEN bad THEN 'Failed to process file: ' || path END AS error
            FROM (SELECT {doc_path} AS path, text, (doc_id % 10) = 3 AS bad FROM documents)""",
        "work_files": f"""WITH f AS (SELECT * FROM {FILES_SQL}),
            asked AS (SELECT doc_id, no, CASE no WHEN 1 THEN 'no ' ELSE '' END || name AS name,
                CASE no WHEN 0 THEN text END AS text FROM f, (VALUES (0), (1)) v(no) WHERE doc_id % 100 = 0),
            found AS (SELECT name, text, name LIKE '%.srt' AS late FROM f WHERE name NOT LIKE '%.md')
            SELECT CAST(0 AS BIGINT) AS origin, CAST(row_number() OVER (ORDER BY doc_id, no) - 1 AS BIGINT) AS position,
                name, text, text IS NULL AS failed FROM asked
            UNION ALL SELECT CAST(1 AS BIGINT), CAST((SELECT count(*) FROM asked)
                + row_number() OVER (ORDER BY late, name) - 1 AS BIGINT), name, text, false FROM found""",
        "work_files_stream": f"""SELECT name, text, CAST(NULL AS VARCHAR) AS error
            FROM {FILES_SQL} WHERE name NOT LIKE '%.md'""",
        "exported_files": wide(
            f"WITH {utterance_ctes(src, 1)} SELECT doc_id, @@, utt_name, content AS text, "
            "CAST(NULL AS VARCHAR) AS error FROM utts", "utt_no"
        ),
        "page_assembly": f"""
            SELECT doc_id, CAST(page_no // 4096 AS BIGINT) AS part_no,
                   string_agg(coalesce(text, '') || {LF}, '' ORDER BY page_no) AS text
            FROM {PAGES_SQL} GROUP BY doc_id, page_no // 4096""",
        "normalized_text": f"{lines} SELECT doc_id, text FROM norm",
        "clean_lines": wide(f"{lines} SELECT doc_id, @@, line FROM cleaned", "pos"),
        "dropped_lines": f"""{lines} SELECT src.doc_id, {", ".join(
            f"CAST(count(*) FILTER (WHERE why = '{d}') AS BIGINT) AS {d}" for d in drops)},
            CAST(count(*) FILTER (WHERE why IS NULL AND e_collapse = '') AS BIGINT) AS emptied
            FROM src JOIN tagged ON src.doc_id = tagged.doc_id
            LEFT JOIN edited ON edited.doc_id = tagged.doc_id AND edited.rpos = tagged.rpos
            GROUP BY src.doc_id""",
        "rule_hits": f"{lines} {hits}",
        "paragraph_ids": wide(
            f"""{lines} SELECT doc_id, @@, line FROM (SELECT doc_id, para_no, line,
            row_number() OVER (PARTITION BY doc_id, para_no ORDER BY pos) - 1 AS line_no
            FROM marked)""",
            "para_no", "line_no",
        ),
        "paragraphs": wide(f"{lines} SELECT doc_id, @@, para FROM kept", "para_no"),
        "normalize_stats": f"""{lines}
            SELECT r.doc_id, r.raw_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS paragraphs
            FROM (SELECT doc_id, CAST(count(*) AS BIGINT) AS raw_lines FROM raw GROUP BY doc_id) r
            LEFT JOIN (SELECT doc_id, count(*) AS n FROM kept GROUP BY doc_id) k
              ON r.doc_id = k.doc_id""",
        "sentences": wide(
            f"WITH {sentence_ctes(lines_ctes(src))} SELECT doc_id, @@, sentence FROM sents", "n"
        ),
        "raw_sentences": wide(
            f"WITH {sentence_ctes(f'src AS (SELECT * FROM {src})', 'src')} "
            "SELECT doc_id, @@, sentence FROM sents",
            "n",
        ),
        "utterances": wide(
            f"WITH {utterance_ctes(src, 1)} SELECT doc_id, @@, utt_name, content FROM utts", "utt_no"
        ),
        "utterances_n2": wide(
            f"WITH {utterance_ctes(src, 2)} SELECT doc_id, @@, utt_name, content FROM utts", "utt_no"
        ),
        "utterance_counts": f"""WITH {utterance_ctes(src, 2)}
            SELECT src.doc_id, CAST(count(utt_no) AS BIGINT) AS utterances
            FROM src LEFT JOIN utts ON src.doc_id = utts.doc_id GROUP BY src.doc_id""",
        "utterances_stream": wide(
            f"WITH {utterance_ctes(noisy_sql(), 1)} SELECT doc_id, @@, utt_name, content FROM utts",
            "utt_no",
        ),
        "srt_detect": f"""SELECT doc_id, regexp_matches(lower(file_name), '[^.].*\\.srt$') AS by_name,
            {DETECTED} AS by_content FROM {subtitle_files_sql()}""",
        "srt_cues": wide(f"{cues} SELECT doc_id, @@, text FROM cues", "cue_no", "start_ms", "end_ms"),
        "srt_flat_text": f"""{cues} SELECT r.doc_id,
            coalesce(string_agg(text, ' ' ORDER BY cue_no), '') AS text
            FROM routed r LEFT JOIN cues c ON r.doc_id = c.doc_id GROUP BY r.doc_id""",
        "srt_time_to_ms": f"""SELECT code, CAST(split_part(code, ':', 1) AS BIGINT) * 3600000
            + CAST(split_part(code, ':', 2) AS BIGINT) * 60000
            + CAST(split_part(split_part(code, ':', 3), ',', 1) AS BIGINT) * 1000
            + CAST(split_part(code, ',', 2) AS BIGINT) AS ms FROM (
            SELECT DISTINCT {sql_timecode("ms")} AS code FROM {times})""",
        "ms_to_srt_time": f"""SELECT doc_id, utt_no, ms, {sql_timecode("trunc(ms)")} AS code FROM (
            SELECT doc_id, CAST(utt_no AS BIGINT) AS utt_no, CAST(ms AS DOUBLE) AS ms FROM {times}
            UNION ALL SELECT 0 AS doc_id, 0 AS utt_no, ms FROM
            {fx.sql_values(fx.F3, "ms, txt")})""",
        "render_srt": f"""{cues} SELECT r.doc_id,
            coalesce(string_agg({rendered}, '' ORDER BY cue_no), '') AS srt
            FROM routed r LEFT JOIN cues c ON r.doc_id = c.doc_id GROUP BY r.doc_id""",
        "cue_placement": wide(
            f"{cues} SELECT doc_id, @@, text FROM cues WHERE text <> ''",
            "cue_no", "start_ms", "end_ms",
        ),
        "cue_track_length": f"""{cues} SELECT r.doc_id,
            CAST(coalesce(max(end_ms), 0) + 1000 AS BIGINT) AS length_ms
            FROM routed r LEFT JOIN cues c ON r.doc_id = c.doc_id GROUP BY r.doc_id""",
        "word_times": wide(f"{words} SELECT utt_id, @@, word, start_ms, end_ms FROM timed", "seq"),
        "phrase_breaks": wide(
            f"{words} SELECT utt_id, @@, word, is_break FROM numbered", "seq", "phrase_no"
        ),
        "phrases": f"{words} SELECT * FROM phrases",
        "phrases_stream": f"{words} SELECT * FROM phrases WHERE utt_id NOT IN ('f4', 'long')",
        "phrases_stream_blocks": f"{words} SELECT * FROM phrases WHERE utt_id NOT IN ('f4', 'long')",
        "phrases_to_srt": f"""{words} SELECT utt_id, CAST(phrase_no // 10000 AS BIGINT) AS part_no,
            string_agg({phrase_block}, '' ORDER BY phrase_no) AS srt FROM phrases
            GROUP BY utt_id, phrase_no // 10000""",
        "synthesis_manifest": f"""WITH {manifest_ctes(src, 1)} SELECT {manifest_columns.replace(
            "rate, pitch, volume", "'+5%' AS rate, '-5Hz' AS pitch, '+10%' AS volume").replace(
            "subtitle_name", "replace(file, '.txt', '.srt') AS subtitle_name")} FROM manifest""",
        "manifest_errors": f"""SELECT doc_id, CAST(utt_no AS BIGINT) AS utt_no,
            printf('page_%04d.txt', utt_no) AS file, 'Please enter text to convert.' AS error
            FROM {blank_pages} WHERE {_strip("content")} = ''""",
        "batch_outcomes": f"{outs} SELECT * FROM outs",
        "output_files": f"""{outs}
            SELECT doc_id, utt_no, CAST(0 AS BIGINT) AS place, audio AS path FROM outs
            WHERE audio IS NOT NULL
            UNION ALL SELECT doc_id, utt_no, CAST(1 AS BIGINT) AS place, subtitle AS path FROM outs
            WHERE subtitle IS NOT NULL""",
        "batch_summary": f"""{outs}, ids AS (SELECT DISTINCT doc_id FROM {src}),
            sums AS (SELECT doc_id, count(*) AS n, count(error) AS f FROM outs GROUP BY doc_id),
            fails AS (SELECT doc_id, (utt_no - 1) // 10000 AS part_no, string_agg('  - ' || file || ': ' || error, chr(10) ORDER BY utt_no) AS lines
                FROM outs WHERE error IS NOT NULL GROUP BY ALL),
            parts AS (SELECT *, coalesce(part_no = min(part_no) OVER (PARTITION BY ids.doc_id), true) AS head
                FROM ids LEFT JOIN sums USING (doc_id) LEFT JOIN fails USING (doc_id))
            SELECT doc_id, CAST(coalesce(part_no, 0) AS BIGINT) AS part_no, CAST(coalesce(n - f, 0) AS BIGINT) AS successful,
                   CAST(coalesce(f, 0) AS BIGINT) AS failed, CAST(coalesce(n, 0) AS BIGINT) AS total,
                   concat_ws(chr(10), CASE WHEN n IS NULL THEN 'No files provided.'
                       WHEN head THEN printf('✅ Processed %d/%d files successfully.', n - f, n) END,
                       CASE WHEN head AND f > 0 THEN printf('❌ %d files failed.', f) END, lines) AS summary FROM parts""",
        "batch_summary_lines": f"""{outs}, sums AS (SELECT doc_id, count(*) AS n, count(error) AS f
            FROM outs GROUP BY doc_id)
            SELECT doc_id, CAST(0 AS BIGINT) AS section, CAST(0 AS BIGINT) AS utt_no,
                   printf('✅ Processed %d/%d files successfully.', n - f, n) AS line FROM sums
            UNION ALL SELECT doc_id, 1, 0, printf('❌ %d files failed.', f) FROM sums WHERE f > 0
            UNION ALL SELECT doc_id, 2, utt_no, '  - ' || file || ': ' || error FROM outs
            WHERE error IS NOT NULL""",
        "batch_requests": wide(
            f"""WITH {batch_ctes()} SELECT doc_id, path, kind, @@, text, 'ta-IN-PallaviNeural' AS voice,
            '+5%' AS rate, '-5Hz' AS pitch, '+0%' AS volume, error FROM requests""",
            "cue_no", "start_ms", "end_ms",
        ),
        "batch_report": batch_report,
        "batch_report_stream": batch_report,
        "merged_tracks": f"""WITH {manifest_ctes(page_texts, 1)},
            heard AS (SELECT doc_id, 'mp3/' || doc_id || '/' || audio_name AS file_name, utt_no, length(text) * 60 AS ms
                FROM manifest WHERE (doc_id * 31 + utt_no) % 7 <> 1)
            SELECT doc_id, file_name, utt_no AS number,
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY utt_no) AS BIGINT) AS position,
            CAST(ms AS BIGINT) AS duration_ms, CAST(coalesce(sum(ms + 500) OVER (PARTITION BY doc_id ORDER BY utt_no
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms FROM heard""",
        "prepare_corpus_counts": f"""WITH {manifest_ctes(src, 2)}
            SELECT stage, metric, CAST(value AS BIGINT) AS value FROM (
            SELECT 'documents' AS stage, 'rows' AS metric, count(*) AS value FROM src
            UNION ALL SELECT 'documents', 'raw_lines', count(*) FROM raw
            UNION ALL SELECT 'normalised', 'rows', count(*) FROM src
            UNION ALL SELECT 'normalised', 'paragraphs', count(*) FROM kept
            UNION ALL SELECT 'utterances', 'rows', count(*) FROM utts
            UNION ALL SELECT 'requests', 'rows', count(*) FROM manifest
            UNION ALL SELECT 'requests', 'failed', count(error) FROM manifest)""",
        "cue_skip_report": f"""{cues}, asked AS (SELECT doc_id, {cue_failed} AS bad FROM cues WHERE text <> '')
            SELECT r.doc_id, CAST(count(bad) AS BIGINT) AS requested,
            CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS skipped,
            CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS placed
            FROM routed r LEFT JOIN asked a ON r.doc_id = a.doc_id GROUP BY r.doc_id""",
        "placed_cues": wide(
            f"{cues} SELECT doc_id, @@, text FROM cues WHERE text <> '' AND NOT ({cue_failed})",
            "cue_no", "start_ms", "end_ms",
        ),
        "track_order": f"WITH {timeline_ctes()} SELECT album_id, file_name, digits, number, position FROM timeline",
        "track_timeline": f"WITH {timeline_ctes()} SELECT * FROM timeline",
        "album_length": f"""SELECT album_id, CAST(count(*) AS BIGINT) AS tracks,
            CAST(sum(duration_ms) + (count(*) - 1) * 500 AS BIGINT) AS total_ms
            FROM {tracks_sql()} GROUP BY album_id""",
        "prepare_corpus": f"WITH {manifest_ctes(src, 2)} SELECT {manifest_columns} FROM manifest",
        "prepare_corpus_from_chunks": f"WITH {manifest_ctes(src, 2)} SELECT {manifest_columns} FROM manifest",
        "prepare_corpus_from_pages": f"""WITH {manifest_ctes(page_texts, 1)} SELECT {manifest_columns} FROM manifest""",
    }
