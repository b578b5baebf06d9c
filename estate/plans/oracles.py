"""DuckDB SQL giving the expected result of each query, written independently of the
DataFrame code over the same given tables."""

from __future__ import annotations

import mimetypes

from estate.plans import tables as t

AS_OF = "TIMESTAMP '2001-08-01 04:00:00'"
RUN_END = "TIMESTAMP '2001-12-01 00:00:00'"
BASE = "Files/Estate"


def _case(subject: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {subject} {arms} END"


_EXT = r"lower(regexp_extract({0}, '^\.*[^.].*(\.[^.]+)$', 1))"


def _size_bucket(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} <= 0 THEN 'unknown' WHEN {c} < 1048576 THEN 'small' "
        f"WHEN {c} < 52428800 THEN 'medium' ELSE 'large' END"
    )


def _age_bucket(c: str) -> str:
    age = f"date_diff('microsecond', {c}, {AS_OF})"
    return (
        f"CASE WHEN {age} < 3600000000 THEN 'recent' WHEN {age} < 86400000000 THEN 'today' "
        f"WHEN {age} < 172800000000 THEN 'yesterday' ELSE 'older' END"
    )


def _human(c: str) -> str:
    arms = f"CASE WHEN {c} = 0 THEN '0 B' "
    for power, unit in ((4, "TB"), (3, "GB"), (2, "MB"), (1, "KB")):
        arms += f"WHEN {c} >= {1024**power} THEN round({c}::DOUBLE / {1024**power}, 2)::VARCHAR || ' {unit}' "
    return arms + f"WHEN {c} IS NOT NULL THEN round({c}::DOUBLE, 2)::VARCHAR || ' B' END"


def _document_type(c: str) -> str:
    low = f"lower({c})"
    return f"""CASE WHEN {low} LIKE '%invoice%' THEN 'Invoice' WHEN {low} LIKE '%receipt%' THEN 'Receipt'
      WHEN {low} LIKE '%contract%' THEN 'Contract' WHEN {low} LIKE '%statement%' THEN 'Statement'
      WHEN regexp_matches({low}, '\\.(pdf|doc|docx)$') THEN 'Document'
      WHEN regexp_matches({low}, '\\.(xls|xlsx|csv)$') THEN 'Spreadsheet'
      WHEN regexp_matches({low}, '\\.(jpg|jpeg|png|tiff)$') THEN 'Image' ELSE 'Other' END"""


_LOG_CLASS = """CASE WHEN {0} LIKE '%401%' OR lower({0}) LIKE '%unauthorized%' THEN 'Authentication'
  WHEN {0} LIKE '%404%' OR lower({0}) LIKE '%not found%' THEN 'File Not Found'
  WHEN lower({0}) LIKE '%timeout%' THEN 'Timeout' WHEN lower({0}) LIKE '%connection%' THEN 'Connection'
  WHEN {0} LIKE '%429%' THEN 'Rate Limit' WHEN {0} LIKE '%500%' OR {0} LIKE '%503%' THEN 'Server Error' ELSE 'Other' END"""
_MONITOR_CLASS = """CASE WHEN {0} LIKE '%401%' OR lower({0}) LIKE '%unauthorized%' THEN 'Authentication'
  WHEN {0} LIKE '%404%' OR lower({0}) LIKE '%not found%' THEN 'File Not Found'
  WHEN lower({0}) LIKE '%timeout%' OR lower({0}) LIKE '%timed out%' THEN 'Timeout'
  WHEN lower({0}) LIKE '%connection%' THEN 'Connection'
  WHEN lower({0}) LIKE '%permission%' OR lower({0}) LIKE '%access%' THEN 'Permission'
  WHEN {0} LIKE '%429%' OR lower({0}) LIKE '%rate limit%' THEN 'Rate Limit'
  WHEN {0} LIKE '%500%' OR {0} LIKE '%503%' OR {0} LIKE '%502%' THEN 'Server Error' ELSE 'Other' END"""
_INSIGHT = """CASE WHEN {0} LIKE '%429%' THEN 'Rate Limiting (429)' WHEN lower({0}) LIKE '%timeout%' THEN 'Timeout'
  WHEN lower({0}) LIKE '%connection%' THEN 'Connection Error' WHEN {0} LIKE '%404%' THEN 'File Not Found (404)'
  WHEN {0} LIKE '%403%' THEN 'Access Denied (403)' ELSE {1} END"""
_INSIGHT_CLASS = _INSIGHT.format("{0}", "'Other Error'")
_DETAIL_CLASS = _INSIGHT.format(
    "{0}", "CASE WHEN contains({0}, ':') THEN left(split_part({0}, ':', 1), 50) ELSE 'Other Error' END"
)

_CTES = {
    "files": f"""SELECT o_orderkey AS file_key,
        CASE WHEN o_orderstatus = 'P' THEN 'Plant Invoices/P' || (4 + o_orderkey % 2)::VARCHAR || '/'
             ELSE 'Processed Invoices/' || strftime(o_orderdate, '%Y/%m') || '/' END
        || CASE left(o_orderpriority, 1) WHEN '1' THEN 'Invoice_' WHEN '2' THEN 'receipt_' WHEN '3' THEN 'Contract_'
             WHEN '4' THEN 'Statement_' ELSE 'scan_' END
        || o_orderkey::VARCHAR || {_case('(o_orderkey % 7)', t.EXTENSIONS)} AS relative_path,
        CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE floor(o_totalprice * 200)::BIGINT END AS size_bytes,
        o_orderdate + to_seconds(o_orderkey % 86400) AS modified_ts
      FROM orders""",
    "named": f"""SELECT *, split_part(relative_path, '/', -1) AS name,
        CASE WHEN contains(relative_path, '/') THEN regexp_replace(relative_path, '/[^/]*$', '') ELSE '.' END AS parent_dir,
        {_EXT.format("split_part(relative_path, '/', -1)")} AS extension
      FROM files""",
    "ledger": f"""SELECT 'run_' || l_linestatus AS run_id, relative_path AS path, l_linenumber::INTEGER AS attempt,
        CASE WHEN l_returnflag <> 'R' THEN 'success' WHEN l_partkey % 16 = 3 THEN 'pending' WHEN l_partkey % 16 = 5 THEN NULL ELSE 'failed' END AS status,
        l_returnflag = 'A' AS skipped,
        CASE WHEN l_returnflag = 'R' THEN {_case('(l_partkey % 8)', t.ERRORS)} END AS error,
        CASE WHEN l_returnflag = 'R' THEN 0 ELSE size_bytes + CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 0 END END::BIGINT AS size_bytes,
        l_shipdate + to_seconds(l_partkey % 86400) AS event_ts,
        (l_suppkey % 10)::INTEGER AS batch, l_orderkey AS entry_index
      FROM lineitem JOIN files ON l_orderkey = file_key""",
    "done": "SELECT DISTINCT path FROM ledger WHERE status = 'success'",
    "latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY event_ts DESC, attempt DESC,
        batch DESC, size_bytes DESC, status DESC, run_id DESC, skipped DESC, error DESC NULLS LAST, entry_index DESC) AS rn
        FROM ledger) WHERE rn = 1""",
    "latest_ok": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY event_ts DESC, attempt DESC,
        batch DESC, size_bytes DESC, status DESC, run_id DESC, skipped DESC, error DESC NULLS LAST, entry_index DESC) AS rn
        FROM ledger WHERE status = 'success') WHERE rn = 1""",
    "manifest": """SELECT CASE WHEN file_key % 13 <> 0 THEN 'id-' || file_key::VARCHAR END AS id,
        split_part(relative_path, '/', -1) AS name, relative_path AS path,
        CASE WHEN file_key % 11 = 0 THEN '' ELSE 'https://h/' || file_key::VARCHAR END AS download_url,
        size_bytes AS size, file_key FROM files""",
    "manifest1": "SELECT * REPLACE (CASE WHEN file_key % 10 = 0 THEN 'Moved/' || path ELSE path END AS path) FROM manifest",
    "disk": "SELECT * REPLACE (CASE WHEN file_key % 5 = 0 THEN 'Moved/' || relative_path ELSE relative_path END AS relative_path) FROM files",
    "matched": """SELECT coalesce(l.path, d.relative_path) AS relative_path,
        CASE WHEN l.path IS NOT NULL AND d.relative_path IS NOT NULL THEN 'matched'
             WHEN d.relative_path IS NOT NULL THEN 'missing_from_progress' ELSE 'missing_from_filesystem' END AS match,
        l.size_bytes AS ledger_size, d.size_bytes AS disk_size,
        CASE WHEN l.path IS NOT NULL AND d.relative_path IS NOT NULL THEN l.size_bytes = d.size_bytes END AS size_match
      FROM latest_ok l FULL JOIN disk d ON l.path = d.relative_path""",
    "registry": """SELECT coalesce(l.path, d.relative_path) AS path, l.path IS NOT NULL AS in_progress,
        d.relative_path IS NOT NULL AS on_filesystem,
        CASE WHEN l.path IS NULL THEN true ELSE NOT l.skipped END AS is_downloaded,
        CASE WHEN l.path IS NULL THEN 'filesystem_only' ELSE coalesce(l.status, 'unknown') END AS status,
        coalesce(d.size_bytes, 0) AS size_bytes, l.event_ts AS ledger_ts, d.modified_ts
      FROM latest_ok l FULL JOIN disk d ON l.path = d.relative_path""",
    "rebuilt": """SELECT m.path, CASE WHEN d.relative_path IS NULL THEN 'pending' ELSE 'success' END AS status,
        CASE WHEN d.relative_path IS NOT NULL THEN m.size END AS size_bytes,
        CASE WHEN d.relative_path IS NULL THEN 'Not found in downloaded files' END AS error
      FROM manifest m LEFT JOIN disk d ON m.path = d.relative_path""",
    "retried": """SELECT run_id, CASE WHEN batch % 2 <> 0 THEN 'Moved/' || path ELSE path END AS path, (attempt + 10)::INTEGER AS attempt,
        CASE WHEN entry_index % 2 = 0 THEN 'success' ELSE 'failed' END AS status, skipped,
        CASE WHEN entry_index % 2 <> 0 THEN error END AS error,
        CASE WHEN entry_index % 2 = 0 THEN entry_index * 10 ELSE 0 END::BIGINT AS size_bytes, event_ts, batch, entry_index
      FROM ledger WHERE status IS DISTINCT FROM 'success'""",
    "prefixes": """SELECT DISTINCT kind, array_to_string(parts[1:i], '/') AS directory FROM (
        SELECT kind, parts, unnest(range(2, len(parts) + 1)) AS i FROM (
          SELECT DISTINCT kind, string_split('Files/Estate/' || regexp_replace(p, '/[^/]*$', ''), '/') AS parts FROM (
            SELECT 'required' AS kind, relative_path AS p FROM files
            UNION ALL SELECT 'created', CASE WHEN relative_path LIKE 'Plant%' OR year(modified_ts) % 2 = 0 THEN '' ELSE 'Moved/' END
              || relative_path FROM files
            UNION ALL SELECT 'attempted', path FROM ledger WHERE status IS DISTINCT FROM 'success') WHERE contains(p, '/')))""",
    "dirs": """SELECT directory, (length(directory) - length(replace(directory, '/', '')))::INTEGER AS depth
      FROM prefixes WHERE kind = 'required'""",
    "totals": """SELECT count(*) AS entries, count(*) FILTER (status = 'success' AND NOT skipped) AS downloaded,
        count(*) FILTER (status = 'success' AND skipped) AS skipped, count(*) FILTER (status IS DISTINCT FROM 'success') AS failed,
        sum(size_bytes)::BIGINT AS total_bytes, min(event_ts) AS started_ts, (SELECT count(*) FROM orders) AS n
      FROM ledger""",
    "rates": f"""SELECT round(e, 6) AS elapsed_seconds, round(downloaded / e * 60, 2) AS files_per_minute,
        round(total_bytes / 1048576 / e, 2) AS mb_per_second, round(100.0::DOUBLE * downloaded / (2 * n), 2) AS completion_rate,
        round(1.0::DOUBLE * total_bytes / downloaded, 6) AS avg_file_bytes, downloaded, total_bytes, n
      FROM (SELECT *, date_diff('microsecond', started_ts, {RUN_END}) / 1000000 AS e FROM totals)""",
    "lines": f"""SELECT 'log-' || (event_id // 1000)::VARCHAR AS file, event_id % 1000 + 1 AS line_number, event_id, ts, event_type AS kind,
        strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || ' - ' || CASE event_type
          WHEN 'click' THEN 'INFO - ✅ Downloaded: Plant Invoices/P4/f' || event_id::VARCHAR || '.pdf'
          WHEN 'error' THEN 'WARNING - ❌ Attempt ' || (1 + event_id % 3)::VARCHAR || ' failed for P5/f' || user_id::VARCHAR || '.pdf: '
            || {_case('(user_id % 5)', t.LOG_ERRORS)}
          WHEN 'view' THEN 'INFO - 🚀 Speed: ' || (event_id % 40)::VARCHAR || '.5 files/sec | ETA: 2.5 hours'
          WHEN 'purchase' THEN 'INFO - 🔥 TURBO Progress: ' || event_id::VARCHAR || '/10000 (' || (event_id // 100)::VARCHAR || '.0%) - '
            || user_id::VARCHAR || ' new downloads'
          ELSE 'INFO - 📁 Processing folder: dir' || user_id::VARCHAR || '/' END AS raw_line
      FROM events""",
    "parsed": """SELECT file, line_number, raw_line, date_trunc('milliseconds', ts) AS event_ts,
        CASE WHEN contains(raw_line, ' - INFO - ') THEN 'INFO' WHEN contains(raw_line, ' - WARNING - ') THEN 'WARNING' END AS level,
        CASE kind WHEN 'click' THEN 'download_success' WHEN 'error' THEN 'download_failed' WHEN 'view' THEN 'speed'
          WHEN 'purchase' THEN 'turbo_progress' ELSE 'folder_processing' END AS event_type FROM lines""",
    "fields": r"""SELECT *,
        CASE WHEN event_type = 'turbo_progress' THEN regexp_extract(raw_line, 'Progress: (\d+)/', 1)::BIGINT END AS current,
        CASE WHEN event_type = 'turbo_progress' THEN regexp_extract(raw_line, 'Progress: \d+/(\d+)', 1)::BIGINT END AS total,
        CASE WHEN event_type = 'turbo_progress' THEN regexp_extract(raw_line, '\((\d+\.?\d*)%\)', 1)::DOUBLE END AS percentage,
        CASE WHEN event_type = 'turbo_progress' THEN regexp_extract(raw_line, '(\d+) new downloads', 1)::BIGINT END AS new_downloads,
        CASE WHEN event_type = 'speed' THEN regexp_extract(raw_line, 'Speed: ([\d.]+) files', 1)::DOUBLE END AS files_per_sec,
        CASE WHEN false THEN 0.0::DOUBLE END AS eta_hours,
        CASE event_type WHEN 'download_success' THEN regexp_extract(raw_line, 'Downloaded: (.+)', 1)
          WHEN 'download_failed' THEN regexp_extract(raw_line, 'failed for (.+): .+', 1) END AS file_path,
        CASE WHEN event_type = 'download_failed' THEN regexp_extract(raw_line, '❌ (.+) failed for', 1) END AS error_type,
        CASE WHEN event_type = 'download_failed' THEN regexp_extract(raw_line, 'failed for .+: (.+)', 1) END AS error_message,
        CASE WHEN event_type = 'folder_processing' THEN regexp_extract(raw_line, 'folder: (.+)', 1) END AS folder_path
      FROM parsed""",
    "outcomes": """SELECT event_id, user_id, 'P' || (user_id % 6)::VARCHAR || '/f' || user_id::VARCHAR AS path,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, event_type = 'view' AS skipped,
        floor(value * 1000)::BIGINT AS size_bytes, ts AS event_ts FROM events""",
    "polls": """SELECT run_id, ts, sum(ok) OVER w AS success, sum(bad) OVER w AS failed FROM (
        SELECT 'run_' || (user_id % 3)::VARCHAR AS run_id, date_trunc('hour', ts) AS ts,
          count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS bad
        FROM events GROUP BY ALL) WINDOW w AS (PARTITION BY run_id ORDER BY ts)""",
    "contents": f"""SELECT doc_id, source || '/' || lang || '/doc_' || doc_id::VARCHAR
        || {_case('(doc_id % 5)', t.DOC_EXTENSIONS)} AS relative_path, text, octet_length(encode(text)) AS size_bytes FROM documents""",
}
_NEEDS = {
    "named": ["files"],
    "ledger": ["files"],
    "done": ["ledger"],
    "latest": ["ledger"],
    "latest_ok": ["ledger"],
    "manifest": ["files"],
    "manifest1": ["manifest"],
    "disk": ["files"],
    "matched": ["latest_ok", "disk"],
    "registry": ["latest_ok", "disk"],
    "rebuilt": ["manifest", "disk"],
    "retried": ["ledger"],
    "prefixes": ["files", "ledger"],
    "dirs": ["prefixes"],
    "totals": ["ledger"],
    "rates": ["totals"],
    "parsed": ["lines"],
    "fields": ["parsed"],
}


def _with(names: str, select: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in wanted) + "\n" + select


_ROLLUP = (
    "count(*) AS file_count, sum(size_bytes)::BIGINT AS total_bytes, "
    "round(sum(size_bytes)::BIGINT / 1073741824, 6) AS total_gb"
)
_BY_EXT = f"SELECT CASE WHEN extension = '' THEN 'no_extension' ELSE extension END AS extension, {_ROLLUP} FROM named GROUP BY 1"
_CATALOG = f"""SELECT md5(relative_path) AS file_id, name AS file_name, relative_path AS file_path,
  '{BASE}/' || relative_path AS target_path, size_bytes AS file_size_bytes, extension AS file_extension, mime_type,
  NULL::TIMESTAMP AS created_date, modified_ts AS modified_date, {AS_OF} AS migration_date, 'pending' AS migration_status,
  NULL::VARCHAR AS checksum, 'library' AS source_system, {_document_type('name')} AS document_type, parent_dir AS folder_structure
  FROM named LEFT JOIN {{mime}} ON extension = ext"""
_SAMPLED = """SELECT parent_dir AS directory, relative_path, size_bytes FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_dir ORDER BY relative_path) AS rn FROM named {where})
  WHERE rn <= 100 ORDER BY relative_path LIMIT 2000"""


def _mime() -> str:
    known = mimetypes.MimeTypes().types_map[True]
    rows = ", ".join(f"('{e}', '{known[e]}')" for e in (".pdf", ".xls", ".msg", ".jpg", ".docx") if e in known)
    return f"(VALUES {rows}) AS m(ext, mime_type)"


def _outcome_counts() -> str:
    return """count(*) FILTER (status = 'success') AS success, count(*) FILTER (status IS DISTINCT FROM 'success') AS failed,
      count(*) FILTER (status = 'success' AND NOT skipped) AS downloaded, count(*) FILTER (status = 'success' AND skipped) AS skipped"""


def _eta(h: str) -> str:
    return (
        f"CASE WHEN {h} < 1 THEN format('{{:.0f}} minutes', {h} * 60) WHEN {h} < 24 THEN format('{{:.1f}} hours', {h}) "
        f"ELSE format('{{:.1f}} days', {h} / 24) END"
    )


def _top_failures(label: str, column: str, limit: str = "") -> str:
    return (
        f"SELECT {label} AS {column}, count(*) AS failures FROM ledger WHERE status IS DISTINCT FROM 'success' "
        f"GROUP BY 1 ORDER BY 2 DESC, 1 {limit}"
    )


_NUM = "format('{{:,}}', {0})"
_SUMMARY = r"""CASE event_type
  WHEN 'turbo_progress' THEN 'Progress: ' || format('{:.1f}', percentage) || '% (' || format('{:,}', current) || '/' || format('{:,}', total) || ')'
  WHEN 'speed' THEN 'Speed: ' || format('{:.1f}', files_per_sec) || ' files/sec'
  WHEN 'download_success' THEN 'Downloaded: ' || split_part(file_path, '/', -1)
  WHEN 'download_failed' THEN 'Failed: ' || split_part(file_path, '/', -1) || ' - ' || error_type
  ELSE left(raw_line, 100) END"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    def put(key: str, names: str, select: str) -> None:
        sql[key] = _with(names, select) if names else select

    # --- columns
    raw = r"'\' || replace(relative_path, '/', '\') || '//x/'"
    put(
        "normalize_path",
        "files",
        f"SELECT file_key, {raw} AS raw_path, relative_path || '/x/' AS plain_path, relative_path || '/x' AS url_path FROM files",
    )
    put(
        "file_attributes",
        "named",
        "SELECT relative_path, name, parent_dir, extension, round(size_bytes / 1048576, 6) AS size_mb, "
        "round(size_bytes / 1073741824, 6) AS size_gb FROM named",
    )
    put("top_folder", "files", "SELECT relative_path, split_part(relative_path, '/', 1) AS top_folder FROM files")
    put("mime_type", "named", f"SELECT relative_path, mime_type FROM named LEFT JOIN {_mime()} ON extension = ext")
    put("document_type", "named", f"SELECT relative_path, {_document_type('name')} AS document_type FROM named")
    put("file_id", "files", "SELECT relative_path, md5(relative_path) AS file_id FROM files")
    put("target_path", "files", f"SELECT relative_path, '{BASE}/' || relative_path AS target_path FROM files")
    put(
        "encode_target_uri",
        "files",
        "SELECT path, replace(url_encode(path), '%2F', '/') AS target_uri FROM (SELECT url || '/é *~+ ' || page_id::VARCHAR AS path "
        "FROM pages UNION ALL SELECT relative_path FROM files)",
    )
    put("convert_uri_scheme", "", "SELECT page_id, url AS uri FROM pages")
    put("size_bucket", "files", f"SELECT relative_path, size_bytes, {_size_bucket('size_bytes')} AS size_bucket FROM files")
    put("age_bucket", "files", f"SELECT relative_path, modified_ts, {_age_bucket('modified_ts')} AS age_bucket FROM files")
    put(
        "classify_error",
        "ledger",
        f"SELECT path, attempt, {_LOG_CLASS.format('error')} AS log_class, {_MONITOR_CLASS.format('error')} AS monitor_class, "
        f"{_INSIGHT_CLASS.format('error')} AS insight_class, {_DETAIL_CLASS.format('error')} AS insight_detail_class "
        "FROM ledger WHERE status IS DISTINCT FROM 'success'",
    )
    put("error_prefix", "ledger", "SELECT path, attempt, split_part(error, ':', 1) AS prefix FROM ledger WHERE status IS DISTINCT FROM 'success'")
    put("human_size", "files", f"SELECT relative_path, size_bytes, {_human('size_bytes')} AS size_label FROM files")
    put("eta_label", "files", f"SELECT relative_path, {_eta('(size_bytes / 1234567.0::DOUBLE)')} AS eta_label FROM files")
    put(
        "truncate_message",
        "",
        "SELECT doc_id, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS message, "
        "right(text, 50) AS tail FROM documents",
    )
    put("large_files", "files", "SELECT relative_path, size_bytes FROM files WHERE size_bytes > 10 * 1024 * 1024")
    put(
        "preflight_violations",
        "files",
        f"""SELECT relative_path, size_bytes, rule FROM (
          SELECT CASE WHEN file_key % 9 = 0 THEN relative_path || ':x' WHEN file_key % 14 = 0 THEN repeat('deep/', 90) || relative_path
            ELSE relative_path END AS relative_path, size_bytes * 1200 AS size_bytes FROM files) f
        JOIN (VALUES ('file_too_large'), ('path_too_long'), ('special_characters')) r(rule) ON
          (rule = 'file_too_large' AND size_bytes > 107374182400)
          OR (rule = 'path_too_long' AND length('{BASE}/' || relative_path) > 400)
          OR (rule = 'special_characters' AND contains(split_part(relative_path, '/', -1), ':'))""",
    )
    put("build_catalog", "named", _CATALOG.format(mime=_mime()))
    sql["write_catalog"] = sql["build_catalog"]

    # --- joins
    put("remaining_files", "done", "SELECT relative_path, size_bytes FROM files WHERE relative_path NOT IN (SELECT path FROM done)")
    put(
        "already_done",
        "done",
        "SELECT relative_path AS path, 'success' AS status, true AS skipped, size_bytes FROM files "
        "WHERE relative_path IN (SELECT path FROM done)",
    )
    put("reconcile", "matched", "SELECT * FROM matched")
    put(
        "reconcile_summary",
        "matched",
        """SELECT count(*) FILTER (match = 'matched') AS matched, count(*) FILTER (match = 'missing_from_progress') AS missing_from_progress,
        count(*) FILTER (match = 'missing_from_filesystem') AS missing_from_filesystem,
        count(*) FILTER (size_match) AS size_matches, count(*) FILTER (NOT size_match) AS size_mismatches,
        sum(disk_size) FILTER (match = 'matched')::BIGINT AS corrected_bytes,
        round(sum(disk_size) FILTER (match = 'matched')::BIGINT / 1073741824, 6) AS corrected_gb FROM matched""",
    )
    put("unify_registry", "registry", "SELECT * FROM registry")
    put("rebuild_ledger", "rebuilt", "SELECT * FROM rebuilt")
    put(
        "rebuild_summary",
        "rebuilt",
        """SELECT count(*) AS total_count, count(*) FILTER (status = 'success') AS downloaded_count,
        count(*) FILTER (status = 'pending') AS failed_count, sum(size_bytes)::BIGINT AS total_size,
        round(100.0::DOUBLE * count(*) FILTER (status = 'success') / count(*), 2) AS success_rate,
        round(100.0::DOUBLE * count(*) FILTER (status = 'success') / count(*), 2) AS completion_percentage FROM rebuilt""",
    )
    put(
        "retry_plan",
        "ledger manifest1",
        """SELECT l.path, attempt, error, id, coalesce(download_url, '') AS download_url, coalesce(size, 0) AS size,
        CASE WHEN coalesce(download_url, '') = '' OR contains(error, '401')
          THEN CASE WHEN id IS NULL THEN 'skip_no_id' ELSE 'refresh_url' END ELSE 'retry_as_is' END AS action
        FROM ledger l LEFT JOIN manifest1 m ON l.path = m.path WHERE status IS DISTINCT FROM 'success'""",
    )
    put(
        "merge_retry",
        "ledger retried",
        """SELECT path, attempt, status, error, size_bytes, batch FROM ledger
          WHERE status = 'success' OR path NOT IN (SELECT path FROM retried)
        UNION ALL SELECT path, attempt, status, error, size_bytes, batch FROM retried""",
    )
    put(
        "retry_summary",
        "retried",
        """SELECT count(*) AS attempted, count(*) FILTER (status = 'success') AS successful,
        count(*) FILTER (status IS DISTINCT FROM 'success') AS still_failed, sum(size_bytes) FILTER (status = 'success')::BIGINT AS recovered_bytes,
        round(100.0::DOUBLE * count(*) FILTER (status = 'success') / count(*), 2) AS success_rate FROM retried""",
    )
    put(
        "retry_history",
        "retried",
        f"""SELECT {AS_OF} AS timestamp, count(*) AS attempted, count(*) FILTER (status = 'success') AS successful,
        count(*) FILTER (status IS DISTINCT FROM 'success') AS still_failed FROM retried""",
    )
    put(
        "retry_statistics",
        "ledger retried",
        """SELECT count(*) AS total_count, count(*) FILTER (ok) AS downloaded_count, count(*) FILTER (NOT ok) AS failed_count,
        sum(size_bytes) FILTER (ok)::BIGINT AS total_size, round(100.0::DOUBLE * count(*) FILTER (ok) / count(*), 2) AS success_rate,
        round(100.0::DOUBLE * count(*) FILTER (ok) / count(*), 2) AS completion_percentage FROM (
          SELECT coalesce(status, '') = 'success' AS ok, size_bytes FROM ledger WHERE status = 'success' OR path NOT IN (SELECT path FROM retried)
          UNION ALL SELECT status = 'success', size_bytes FROM retried)""",
    )
    put("read_inventory", "files", "SELECT relative_path, size_bytes, modified_ts FROM files")
    put("read_directories", "dirs", "SELECT directory FROM dirs")
    put(
        "resume_batches",
        "files",
        """SELECT * FROM (SELECT relative_path, size_bytes, p AS position, (p - 1) // 100 + 1 AS batch
          FROM (SELECT *, row_number() OVER (ORDER BY size_bytes, relative_path) AS p FROM files))
        WHERE batch NOT IN (SELECT s_suppkey * 2 FROM supplier)""",
    )
    put(
        "clear_failed",
        "ledger",
        """SELECT run_id, count(*) AS entries, 'kept' AS action FROM ledger WHERE status = 'success' GROUP BY 1
        UNION ALL SELECT 'history', count(*), 'cleared_failed_status' FROM ledger WHERE status IS DISTINCT FROM 'success'""",
    )
    put(
        "dir_coverage",
        "prefixes",
        """SELECT coalesce(c.directory, a.directory) AS directory, CASE WHEN c.directory IS NOT NULL AND a.directory IS NOT NULL THEN 'both'
          WHEN c.directory IS NOT NULL THEN 'created_only' ELSE 'attempted_only' END AS coverage
        FROM (SELECT directory FROM prefixes WHERE kind = 'created') c
        FULL JOIN (SELECT directory FROM prefixes WHERE kind = 'attempted') a ON c.directory = a.directory""",
    )
    put(
        "sync_plan",
        "files",
        """SELECT relative_path, size_bytes, CASE WHEN file_key % 4 = 0 THEN 'create' WHEN file_key % 3 = 0 THEN 'overwrite'
          ELSE 'skip' END AS action FROM files""",
    )
    put("new_files", "manifest manifest1", "SELECT path, id, size FROM manifest WHERE path NOT IN (SELECT path FROM manifest1)")
    ready = "FROM manifest WHERE path IN (SELECT relative_path FROM disk)"
    put("migration_ready", "manifest disk", f"SELECT path, path AS target_path, size {ready}")
    put("sample_migration", "manifest disk", f"SELECT path AS target_path, size {ready} ORDER BY path LIMIT 100")

    # --- roll-ups
    put(
        "inventory_totals",
        "files",
        f"SELECT {_ROLLUP}, round(sum(size_bytes)::BIGINT / 1048576 / count(*), 6) AS avg_mb FROM files",
    )
    put("by_extension", "named", _BY_EXT)
    put("by_directory", "named", f"SELECT parent_dir AS directory, {_ROLLUP} FROM named GROUP BY 1")
    sql["write_report_json"] = sql["by_directory"]
    put("by_document_type", "named", f"SELECT {_document_type('name')} AS document_type, {_ROLLUP} FROM named GROUP BY 1")
    put(
        "migration_estimate",
        "files",
        f"""SELECT n AS file_count, b AS total_bytes, round(b / 1073741824 / 10, 6) AS duration_hours,
        round(b / 1073741824 * 0.023::DOUBLE, 6) AS monthly_cost, format('${{:.2f}}/month', b / 1073741824 * 0.023::DOUBLE) AS monthly_cost_label,
        least(1000, n // 10)::BIGINT AS batch_size, round(n / 50 / 3600, 1) AS file_rate_hours,
        round(a / 1073741824 * 0.002::DOUBLE, 6) AS archive_cost
        FROM (SELECT count(*) AS n, sum(size_bytes)::BIGINT AS b,
          sum(size_bytes) FILTER (modified_ts < {AS_OF} - INTERVAL 30 DAY)::BIGINT AS a FROM files)""",
    )
    put(
        "adaptive_batch_size",
        "named",
        """SELECT directory, round(avg_b, 6) AS avg_bytes,
        CASE WHEN avg_b < 1000000 THEN 100 WHEN avg_b < 10000000 THEN 50 ELSE 20 END::INTEGER AS batch_size
        FROM (SELECT parent_dir AS directory, sum(size_bytes)::BIGINT / count(*) AS avg_b FROM named GROUP BY 1)""",
    )
    put(
        "file_stats",
        "named",
        """SELECT count(*) AS file_count, sum(size_bytes)::BIGINT AS total_bytes, count(DISTINCT parent_dir) AS folder_count,
        round(sum(size_bytes)::BIGINT / count(*), 6) AS avg_bytes FROM named""",
    )
    put("size_distribution", "files", f"SELECT {_size_bucket('size_bytes')} AS size_bucket, count(*) AS file_count FROM files GROUP BY 1")
    put(
        "age_distribution",
        "registry",
        f"SELECT {_age_bucket('coalesce(ledger_ts, modified_ts)')} AS age_bucket, count(*) AS file_count FROM registry GROUP BY 1",
    )
    put(
        "folder_distribution",
        "files",
        "SELECT split_part(relative_path, '/', 1) AS top_folder, count(*) AS file_count FROM files GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    )
    put(
        "insight_summary",
        "registry",
        f"""SELECT round(b / 1073741824, 2) AS total_size_gb, round(b / 1048576 / greatest(dl, 1), 2) AS avg_file_size_mb,
        unique_file_types, unique_folders, files_processed, dl AS files_downloaded, files_with_size FROM (
          SELECT sum(size_bytes)::BIGINT AS b, count(*) FILTER (is_downloaded) AS dl, count(*) FILTER (size_bytes > 0) AS files_with_size,
            count(DISTINCT {_EXT.format("split_part(path, '/', -1)")}) AS unique_file_types,
            count(DISTINCT split_part(path, '/', 1)) AS unique_folders, count(*) AS files_processed FROM registry)""",
    )
    put(
        "estimate_total_size",
        "named",
        """SELECT all_files, n AS sampled_files, b AS sampled_bytes, 1.0::DOUBLE AS scale_factor, round(b / 1073741824, 6) AS estimated_gb
        FROM (SELECT count(*) AS all_files, count(*) FILTER (t) AS n, coalesce(sum(size_bytes) FILTER (t), 0)::BIGINT AS b
          FROM (SELECT size_bytes, extension IN ('.pdf', '.xls', '.xlsx', '.msg', '.jpg', '.png') AS t FROM named))""",
    )
    put(
        "ledger_status_counts",
        "ledger",
        "SELECT CASE WHEN status IS DISTINCT FROM 'success' THEN 'failed' WHEN skipped THEN 'skipped' ELSE 'downloaded' END AS outcome, "
        "count(*) AS entries FROM ledger GROUP BY 1",
    )
    which = "CASE WHEN batch >= 5 THEN 'turbo' ELSE 'plain' END"
    put("union_ledgers", "ledger", f"SELECT {which} AS ledger_id, path, attempt, status, batch FROM ledger")
    put(
        "ledger_compare",
        "ledger",
        f"""SELECT {which} AS ledger_id, max(entry_index) AS last_index, {_outcome_counts()}, sum(size_bytes)::BIGINT AS total_bytes,
        max(event_ts) AS last_event_ts, round(100.0::DOUBLE * max(entry_index) / (SELECT count(*) FROM orders), 6) AS progress_pct
        FROM ledger GROUP BY 1""",
    )
    put(
        "progress_stats",
        "totals",
        f"""SELECT total AS total_files, processed, downloaded, skipped, failed, entries, round(100.0::DOUBLE * processed / total, 6) AS progress_pct,
        greatest(0, total - processed) AS remaining, round(100.0::DOUBLE * downloaded / greatest(processed, 1), 6) AS success_rate,
        round(h, 6) AS eta_hours, {_eta('h')} AS eta_label
        FROM (SELECT *, greatest(0, total - processed) / 25 / 3600 AS h FROM (
          SELECT *, 10 * n AS total, least(entries, 10 * n) AS processed FROM totals))""",
    )
    put(
        "health_metrics",
        "totals",
        """SELECT round(100.0::DOUBLE * entries / (5 * n), 6) AS progress_pct, 5 * n - entries AS remaining,
        round((5 * n - entries) / 90000, 6) AS eta_hours, round(100.0::DOUBLE * downloaded / entries, 6) AS success_rate,
        round(100.0::DOUBLE * failed / entries, 6) AS error_rate FROM totals""",
    )
    put("throughput_metrics", "rates", "SELECT * EXCLUDE (n) FROM rates")
    put(
        "completion_forecast",
        "rates",
        f"""SELECT r AS remaining_files, round(m, 6) AS remaining_minutes, {RUN_END} + to_seconds(floor(m * 60)::BIGINT) AS completion_ts,
        rb AS remaining_bytes, total_bytes + rb AS projected_bytes, {_human('rb')} AS remaining_size
        FROM (SELECT *, CASE WHEN r > 0 AND files_per_minute > 0 THEN r / files_per_minute END AS m, floor(r * avg_file_bytes)::BIGINT AS rb
          FROM (SELECT *, 2 * n - downloaded AS r FROM rates))""",
    )
    put(
        "ledger_quality",
        "ledger",
        """SELECT count(*) AS entries, count(*) FILTER (size_bytes > 0) AS with_size, count(*) FILTER (size_bytes = 0) AS without_size,
        round(sum(size_bytes)::BIGINT / 1073741824, 6) AS total_gb,
        round(sum(size_bytes)::BIGINT / 1048576 / count(*) FILTER (size_bytes > 0), 6) AS avg_mb,
        count(event_ts) AS with_timestamp, count(DISTINCT path) AS distinct_paths FROM ledger WHERE status = 'success'""",
    )
    put(
        "manifest_scope",
        "manifest disk",
        """SELECT count(*) AS listed_files, count(DISTINCT regexp_replace(path, '/[^/]*$', '')) AS target_directories,
        sum(size)::BIGINT AS total_bytes, count(*) FILTER (path IN (SELECT relative_path FROM disk)) AS ready_files FROM manifest""",
    )
    put(
        "batch_summary",
        "ledger",
        f"SELECT run_id, batch, {_outcome_counts()}, sum(size_bytes)::BIGINT AS total_bytes FROM ledger GROUP BY 1, 2",
    )
    put(
        "run_summary",
        "ledger",
        f"""SELECT run_id, success, failed, downloaded, skipped, paths_done, round(100.0::DOUBLE * success / (success + failed), 6) AS success_rate,
        round(date_diff('microsecond', a, z) / 1000000 / 3600, 6) AS duration_hours, greatest(n - paths_done, 0) AS remaining,
        paths_done >= n AS complete FROM (SELECT run_id, {_outcome_counts()}, count(DISTINCT path) FILTER (status = 'success') AS paths_done,
          min(event_ts) AS a, max(event_ts) AS z, (SELECT count(*) FROM orders) AS n FROM ledger GROUP BY 1)""",
    )
    put("failure_reasons", "ledger", _top_failures("error", "reason"))
    put("failure_classes", "ledger", _top_failures(_MONITOR_CLASS.format("error"), "error_class"))
    put("failure_classes_top", "ledger", _top_failures(_DETAIL_CLASS.format("error"), "error_class", "LIMIT 5"))
    put("failure_prefixes", "ledger", _top_failures("split_part(error, ':', 1)", "prefix"))
    put(
        "error_feed",
        "ledger",
        """SELECT 'download_failure' AS type, path AS file, error, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS timestamp
          FROM ledger WHERE status IS DISTINCT FROM 'success' AND batch < 5
        UNION ALL SELECT 'download_failure', path, 'Download failed', 'Unknown' FROM ledger WHERE status IS DISTINCT FROM 'success' AND batch >= 5
        UNION ALL SELECT 'system_error', 'Multiple files', count(*)::VARCHAR || ' errors encountered during download', '2001-08-01 04:00:00'
          FROM ledger WHERE status IS DISTINCT FROM 'success'""",
    )
    put(
        "alerts",
        "ledger",
        """SELECT run_id, batch, alert, level, value FROM (SELECT run_id, batch, unnest([
            CASE WHEN disk > 90 THEN {'alert': 'disk_low', 'level': 'danger', 'value': disk} END,
            CASE WHEN disk > 80 AND disk <= 90 THEN {'alert': 'disk_filling', 'level': 'warning', 'value': disk} END,
            CASE WHEN er > 10 THEN {'alert': 'high_error_rate', 'level': 'warning', 'value': er} END,
            CASE WHEN pr > 95 THEN {'alert': 'almost_complete', 'level': 'success', 'value': pr} END], recursive := true)
          FROM (SELECT run_id, batch, (70 + 3 * batch)::DOUBLE AS disk,
            round(100.0::DOUBLE * count(*) FILTER (status IS DISTINCT FROM 'success') / count(*), 6) AS er,
            round(140.0::DOUBLE * count(*) FILTER (status = 'success') / count(*), 6) AS pr FROM ledger GROUP BY 1, 2))
        WHERE alert IS NOT NULL""",
    )
    put("dirs_by_depth", "dirs", "SELECT depth, count(*) AS directory_count FROM dirs GROUP BY 1")

    # --- order, windows, sets
    put(
        "assign_batches",
        "files",
        """SELECT relative_path, size_bytes, p AS position, (p - 1) // 100 + 1 AS batch
        FROM (SELECT *, row_number() OVER (ORDER BY size_bytes, relative_path) AS p FROM files)""",
    )
    put(
        "snapshot_deltas",
        "polls",
        """SELECT run_id, ts, success::BIGINT AS success, failed::BIGINT AS failed, (success - ps)::BIGINT AS success_delta,
        (failed - pf)::BIGINT AS failed_delta, coalesce(success - ps > 0 OR failed - pf <> 0, false) AS changed
        FROM (SELECT *, lag(success) OVER w AS ps, lag(failed) OVER w AS pf FROM polls WINDOW w AS (PARTITION BY run_id ORDER BY ts))""",
    )
    put(
        "snapshot_rate",
        "polls",
        """SELECT run_id, ts, success::BIGINT AS success,
        CASE WHEN success > ps THEN round((success - ps)::DOUBLE / date_diff('second', pt, ts), 6) ELSE 0.0::DOUBLE END AS files_per_second
        FROM (SELECT *, lag(success) OVER w AS ps, lag(ts) OVER w AS pt FROM polls WINDOW w AS (PARTITION BY run_id ORDER BY ts))""",
    )
    put(
        "running_batch_speed",
        "ledger",
        """SELECT run_id, batch, round(s, 6) AS batch_speed, round(avg(s) OVER (PARTITION BY run_id ORDER BY batch), 6) AS running_speed
        FROM (SELECT run_id, date_diff('day', DATE '1995-01-01', event_ts::DATE)::INTEGER AS batch,
          count(*) / sum(attempt)::DOUBLE AS s FROM ledger GROUP BY 1, 2)""",
    )
    put(
        "progress_milestones",
        "ledger",
        """SELECT run_id, c AS completed, event_ts, round(100.0::DOUBLE * c / n, 6) AS progress_pct, round(s, 6) AS files_per_second,
        round(CASE WHEN s > 0 THEN (n - c) / s / 3600 ELSE 0.0::DOUBLE END, 6) AS eta_hours FROM (
          SELECT *, 5 * (SELECT count(*) FROM orders) AS n,
            CASE WHEN event_ts > t0 THEN c / (date_diff('microsecond', t0, event_ts) / 1000000) ELSE 0.0::DOUBLE END AS s
          FROM (SELECT run_id, event_ts, row_number() OVER (PARTITION BY run_id ORDER BY event_ts) AS c,
            min(event_ts) OVER (PARTITION BY run_id) AS t0 FROM ledger) WHERE c % 50 = 0)""",
    )
    put("dedupe_latest", "latest", "SELECT * FROM latest")
    put(
        "top_dirs_per_depth",
        "dirs",
        """SELECT depth, directory, greatest(n - 5, 0) AS more FROM (SELECT *, count(*) OVER (PARTITION BY depth) AS n,
          row_number() OVER (PARTITION BY depth ORDER BY directory) AS rn FROM dirs) WHERE rn <= 5""",
    )
    put("sample_per_dir", "named", _SAMPLED.format(where=""))
    put("top_types_by_size", "named", f"{_BY_EXT} ORDER BY total_bytes DESC, 1 LIMIT 10")
    put("top_types_by_count", "named", f"{_BY_EXT} ORDER BY file_count DESC, 1 LIMIT 10")
    put(
        "largest_files",
        "files",
        f"SELECT relative_path, size_bytes, round(size_bytes / 1048576, 2) AS size_mb, {_human('size_bytes')} AS size_label "
        "FROM files WHERE size_bytes > 0 ORDER BY size_bytes DESC, relative_path LIMIT 10",
    )
    put(
        "recent_files",
        "files",
        "SELECT relative_path, modified_ts, round(size_bytes / 1048576, 2) AS size_mb, right(relative_path, 50) AS path_tail "
        "FROM files ORDER BY modified_ts DESC, relative_path LIMIT 10",
    )
    put(
        "dirs_creation_order",
        "dirs",
        """SELECT directory, depth, p AS position, (p - 1) // 10 + 1 AS batch
        FROM (SELECT *, row_number() OVER (ORDER BY depth, directory) AS p FROM dirs)""",
    )
    put("directory_prefixes", "dirs", "SELECT directory FROM dirs")
    put(
        "missing_dirs",
        "prefixes",
        "SELECT directory FROM prefixes WHERE kind = 'required' EXCEPT SELECT directory FROM prefixes WHERE kind = 'created'",
    )
    put(
        "flatten_hierarchy",
        "",
        """SELECT c_custkey + 3000000000 AS id, r_name || '/' || n_name || '/' || c_name || '.pdf' AS path, c_name || '.pdf' AS name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_7'""",
    )
    put(
        "resolve_folder",
        "",
        """SELECT '/' || CASE WHEN c_custkey % 10 = 0 THEN lower(r_name) ELSE r_name END || '/' || n_name || '/' AS folder_path,
        CASE WHEN c_custkey % 10 <> 0 THEN n_nationkey::BIGINT + 2000000000 END AS folder_id, c_custkey % 10 <> 0 AS found
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    )

    # --- ledger snapshots
    put(
        "select_best_ledger",
        "",
        """SELECT o_custkey AS source_id, o_orderkey AS candidate_id, left(o_orderpriority, 1)::INTEGER AS priority, o_orderdate AS backup_ts
        FROM orders WHERE o_orderkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY left(o_orderpriority, 1), o_orderdate DESC, o_orderkey) = 1""",
    )
    put(
        "ledger_freshness",
        "",
        """SELECT o_orderkey AS snapshot_id, o_orderstatus = 'O' AND o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 AND
          CASE WHEN o_orderkey % 11 = 0 THEN true WHEN o_orderkey % 13 = 0 THEN false
            ELSE TIMESTAMP '2001-08-01' - o_orderdate <= INTERVAL 900 DAY END AS is_valid FROM orders""",
    )
    entry = "event_id // 500 % 6 + 1"
    put(
        "read_ledger",
        "outcomes",
        f"""SELECT layout, path, status, skipped, error, size_bytes, event_ts, batch FROM (
          SELECT 'L' || n::VARCHAR AS layout, CASE WHEN event_id % 19 <> 0 THEN path || '-' || event_id::VARCHAR ELSE '' END AS path,
            CASE WHEN ok THEN 'success' WHEN n = 5 THEN 'pending' ELSE 'failed' END AS status,
            CASE WHEN n = 1 AND ok THEN skipped ELSE false END AS skipped,
            CASE WHEN NOT ok THEN CASE WHEN n = 6 AND event_id % 10 >= 5 THEN 'Download failed'
              ELSE 'HTTP ' || (400 + event_id % 5)::VARCHAR END END AS error,
            CASE WHEN ok AND n IN (2, 5) THEN size_bytes END AS size_bytes,
            CASE WHEN n IN (2, 5) OR (NOT ok AND n IN (3, 4)) OR (n = 6 AND event_id % 10 < 5) THEN event_ts END AS event_ts,
            CASE WHEN n = 2 THEN event_id % 10 END::INTEGER AS batch, ok, n
          FROM (SELECT *, status = 'success' AS ok, {entry} AS n FROM outcomes))
        WHERE path <> '' AND NOT (ok AND n IN (4, 6))""",
    )
    put(
        "read_ledger_tolerant",
        "outcomes",
        """SELECT doc % 4 = 3 AS is_corrupt, count(*) AS documents,
          sum(CASE WHEN doc % 4 = 3 THEN 0 ELSE s END)::BIGINT AS success, sum(CASE WHEN doc % 4 = 3 THEN 0 ELSE f END)::BIGINT AS failed
        FROM (SELECT event_id // 100 AS doc, count(*) FILTER (status = 'success') AS s, count(*) FILTER (status IS DISTINCT FROM 'success') AS f
          FROM outcomes GROUP BY 1) GROUP BY 1""",
    )
    put(
        "read_manifest",
        "manifest",
        """SELECT path, id, name, download_url, size, '2001-08-01T00:00:00' AS timestamp, count(*) OVER (PARTITION BY file_key // 500) AS total_files,
        'site-1' AS site_id, 'drive-' || (file_key // 500)::VARCHAR AS drive_id FROM manifest""",
    )
    put(
        "append_ledger",
        "ledger",
        "SELECT run_id, batch, path, attempt, status, size_bytes, event_ts FROM ledger",
    )
    put(
        "backup_ledger",
        "ledger",
        """SELECT '20010801_040000' AS snapshot_id, status, count(*) AS entries FROM ledger GROUP BY 2
        UNION ALL SELECT 'current', status, count(*) FROM ledger WHERE status = 'success' GROUP BY 2""",
    )

    # --- files
    put("scan_files", "contents", "SELECT relative_path, size_bytes FROM contents")
    put(
        "scan_files_filtered",
        "contents",
        "SELECT relative_path, size_bytes FROM contents WHERE doc_id % 6 <> 0 AND doc_id % 5 <> 3",
    )
    put("content_checksum", "contents", "SELECT relative_path, md5(text) AS checksum, NULL::VARCHAR AS error FROM contents")
    put(
        "copy_files",
        "contents",
        """SELECT relative_path AS path, CASE WHEN doc_id % 10 = 0 THEN 'failed' ELSE 'success' END AS status,
        doc_id % 10 <> 0 AND doc_id % 7 = 0 AS skipped, CASE WHEN doc_id % 10 = 0 THEN 'source file not found' END AS error,
        CASE WHEN doc_id % 10 <> 0 THEN size_bytes END AS size_bytes,
        CASE WHEN doc_id % 10 <> 0 AND doc_id % 7 <> 0 THEN 1 ELSE 0 END::INTEGER AS attempt,
        CASE WHEN doc_id % 10 <> 0 AND doc_id % 7 <> 0 THEN md5(text) END AS checksum FROM contents""",
    )

    put(
        "copy_sync_plan",
        "contents",
        """SELECT relative_path AS path, 'success' AS status, NOT copied AS skipped, NULL::VARCHAR AS error, size_bytes,
        CASE WHEN copied THEN 1 ELSE 0 END::INTEGER AS attempt, CASE WHEN copied THEN md5(text) END AS checksum
        FROM (SELECT *, doc_id % 3 = 0 OR doc_id % 5 < 2 AS copied FROM contents)""",
    )

    # --- logs
    put(
        "read_log_lines",
        "lines",
        "SELECT file, line_number + (line_number - 1) // 10 AS line_number, raw_line FROM lines",
    )
    put("parse_log", "parsed", "SELECT file, line_number, event_ts, level, event_type, raw_line FROM parsed")
    put(
        "parse_log_fields",
        "fields",
        "SELECT file, line_number, event_type, current, total, percentage, new_downloads, files_per_sec, eta_hours, file_path, "
        "error_type, error_message, folder_path FROM fields",
    )
    # every field straight from the numbers the lines are made of
    put(
        "parse_log_fields_all_types",
        "",
        """WITH kinds AS (SELECT event_id AS line_id, user_id AS u, event_id % 10 AS k, strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS stamp FROM events),
        typed AS (SELECT *, ['turbo_progress', 'speed', 'eta', 'download_success', 'download_failed', 'auth_token', 'folder_processing',
            'turbo_mode', 'resume', 'unknown'][CAST(k + 1 AS INT)] AS event_type FROM kinds)
        SELECT line_id, event_type,
        CASE WHEN k = 0 THEN line_id END AS current,
        CASE WHEN k IN (0, 8) THEN line_id + u END AS total,
        CASE WHEN k = 0 THEN CAST(12.5 AS DOUBLE) END AS percentage,
        CASE WHEN k = 0 THEN u END AS new_downloads,
        CASE WHEN k = 1 THEN CAST(u % 40 + 0.25 AS DOUBLE) END AS files_per_sec,
        CASE WHEN k = 2 THEN CAST(u % 90 + 0.75 AS DOUBLE) END AS eta_hours,
        CASE k WHEN 3 THEN 'P1/f' || line_id || '.pdf' WHEN 4 THEN 'P2/f' || line_id || '.pdf' END AS file_path,
        CASE WHEN k = 4 THEN 'Attempt ' || (u % 3 + 1) END AS error_type,
        CASE WHEN k = 4 THEN 'HTTP 429' END AS error_message,
        CASE WHEN k = 6 THEN 'dir' || u || '/' END AS folder_path,
        CASE WHEN k = 7 THEN u % 64 + 1 END AS workers,
        CASE WHEN k = 8 THEN line_id END AS resume_from,
        CASE CAST(k AS INT)
            WHEN 0 THEN 'Progress: 12.5% (' || format('{:,}', line_id) || '/' || format('{:,}', line_id + u) || ')'
            WHEN 1 THEN 'Speed: ' || printf('%.1f', u % 40 + 0.3) || ' files/sec'
            WHEN 2 THEN stamp || ' - INFO - ⏰ ETA: ' || (u % 90) || '.75 hours'
            WHEN 3 THEN 'Downloaded: f' || line_id || '.pdf'
            WHEN 4 THEN 'Failed: f' || line_id || '.pdf - Attempt ' || (u % 3 + 1)
            WHEN 5 THEN stamp || ' - INFO - 🔐 Worker ' || u || ': Authenticating'
            WHEN 6 THEN stamp || ' - INFO - 📁 Processing folder: dir' || u || '/'
            WHEN 7 THEN 'Started with ' || (u % 64 + 1) || ' workers'
            WHEN 8 THEN 'Resumed from file ' || format('{:,}', line_id)
            ELSE stamp || ' - INFO - Waiting for worker ' || u END AS summary
        FROM typed""",
    )
    put(
        "parse_log_fields_first_colon",
        "fields",
        r"""SELECT file, line_number, event_type,
        CASE WHEN event_type = 'download_failed' THEN regexp_extract(raw_line, 'failed for ([^:]+): ', 1) ELSE file_path END AS file_path,
        error_type, CASE WHEN event_type = 'download_failed' THEN regexp_extract(raw_line, 'failed for [^:]+: (.+)', 1) END AS error_message
        FROM fields""",
    )
    span = "min(event_ts) AS first_ts, max(event_ts) AS last_ts, round(date_diff('microsecond', min(event_ts), max(event_ts)) / 1000000 / 3600, 6) AS duration_hours"
    put(
        "log_summary",
        "parsed",
        f"""SELECT 'event_type' AS section, event_type AS label, count(*) AS events, {span} FROM parsed GROUP BY 2
        UNION ALL SELECT 'level', level, count(*), {span} FROM parsed WHERE level IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'all', 'all', count(*), {span} FROM parsed""",
    )
    put(
        "log_performance",
        "fields",
        """SELECT count(*) FILTER (event_type = 'speed') AS speed_samples, count(*) FILTER (event_type = 'turbo_progress') AS progress_samples,
        round(avg(files_per_sec), 6) AS avg_speed, max(files_per_sec) AS max_speed, min(files_per_sec) AS min_speed,
        arg_max(percentage, (event_ts, file, line_number)) FILTER (event_type = 'turbo_progress') AS current_progress,
        arg_max(current, (event_ts, file, line_number)) FILTER (event_type = 'turbo_progress') AS files_processed,
        arg_max(total, (event_ts, file, line_number)) FILTER (event_type = 'turbo_progress') AS total_files FROM fields""",
    )
    put(
        "log_errors",
        "fields",
        f"""SELECT CASE WHEN event_type = 'download_failed' THEN {_LOG_CLASS.format('error_message')} ELSE 'Other' END AS error_class,
        count(*) AS errors FROM fields WHERE level = 'ERROR' OR lower(raw_line) LIKE '%failed%' GROUP BY 1""",
    )
    put(
        "log_hourly",
        "parsed",
        "SELECT strftime(event_ts, '%H:00') AS hour, count(*) AS downloads FROM parsed WHERE event_type = 'download_success' GROUP BY 1",
    )
    put(
        "log_common_errors",
        "lines",
        "SELECT substr(raw_line, 25) AS raw_line, count(*) AS occurrences FROM lines WHERE lower(raw_line) LIKE '%failed%' "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    )
    last = "ORDER BY event_ts DESC, file DESC, line_number DESC LIMIT"
    put(
        "recent_errors",
        "parsed",
        f"""SELECT event_ts, file, line_number, event_type,
        CASE WHEN length(raw_line) > 100 THEN left(raw_line, 100) || '...' ELSE raw_line END AS message
        FROM parsed WHERE lower(raw_line) LIKE '%failed%' {last} 20""",
    )
    put("log_timeline", "fields", f"SELECT event_ts, file, line_number, event_type, level, {_SUMMARY} AS summary FROM fields {last} 50")

    # --- streaming
    put("stream_log_events", "parsed", "SELECT event_ts, level, event_type, raw_line FROM parsed")
    put(
        "stream_throughput",
        "outcomes",
        """SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end, status,
        count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM outcomes GROUP BY ALL""",
    )
    put(
        "stream_sliding_error_rate",
        "outcomes",
        """SELECT *, round(100.0::DOUBLE * failed / files, 6) AS error_rate FROM (
          SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS files, count(*) FILTER (status IS DISTINCT FROM 'success') AS failed
          FROM (SELECT status, time_bucket(INTERVAL 15 MINUTE, event_ts) - to_minutes(15 * k) AS s
            FROM outcomes, range(4) r(k)) GROUP BY 1) WHERE 100.0::DOUBLE * failed / files > 10""",
    )
    put("stream_dedupe_ledger", "outcomes", "SELECT DISTINCT path, status FROM outcomes")
    put(
        "stream_ledger_upsert",
        "outcomes",
        "SELECT 'live' AS run_id, path, status, skipped, size_bytes, event_ts FROM outcomes",
    )
    put(
        "stream_idle_detect",
        "outcomes",
        """SELECT run_id, min(event_ts) AS window_start, max(event_ts) + INTERVAL 10 MINUTE AS window_end, count(*) AS files,
          count(*) FILTER (status = 'success' AND NOT skipped) AS downloaded
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY run_id ORDER BY event_ts) AS session FROM (
          SELECT *, 'run_' || (user_id % 3)::VARCHAR AS run_id,
            CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY user_id % 3 ORDER BY event_ts) > INTERVAL 10 MINUTE THEN 1 ELSE 0 END AS fresh
          FROM outcomes))
        GROUP BY run_id, session
        HAVING max(event_ts) + INTERVAL 10 MINUTE <= (SELECT date_trunc('milliseconds', max(event_ts)) FROM outcomes) - INTERVAL 10 MINUTE""",
    )
    for key, same in {
        "dedupe_latest_spellings": "dedupe_latest", "run_summary_spellings": "run_summary", "ledger_quality_spellings": "ledger_quality",
        "path_ledger_latest": "dedupe_latest", "path_ledger_remaining": "remaining_files",
    }.items():
        sql[key] = sql[same]  # however a path is written, it names the same file
    # a row is late if its windows ended before what the arrivals up to the last but one had reached, less the allowed delay
    arriving = """arrivals AS (
      SELECT *, least(7, (epoch_us(event_ts) - min(epoch_us(event_ts)) OVER ()) * 8 // (max(epoch_us(event_ts)) OVER () - min(epoch_us(event_ts)) OVER () + 1)
        + CASE user_id % 11 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END) AS arrival FROM outcomes
    ), reached AS (SELECT arrival, max(event_ts) AS top FROM arrivals GROUP BY 1
    ), marks AS (SELECT a.arrival, date_trunc('milliseconds', max(b.top)) - INTERVAL 10 MINUTE AS mark
      FROM reached a LEFT JOIN reached b ON b.arrival <= a.arrival - 2 GROUP BY 1)"""
    put(
        "stream_throughput_late",
        "outcomes",
        f"""SELECT * FROM (WITH {arriving} SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
          status, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM arrivals JOIN marks USING (arrival)
          WHERE mark IS NULL OR date_trunc('hour', event_ts) + INTERVAL 1 HOUR > mark GROUP BY ALL)""",
    )
    put(
        "stream_sliding_error_rate_late",
        "outcomes",
        f"""SELECT *, round(100.0::DOUBLE * failed / files, 6) AS error_rate FROM (WITH {arriving}
          SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS files, count(*) FILTER (status IS DISTINCT FROM 'success') AS failed
          FROM (SELECT status, mark, time_bucket(INTERVAL 15 MINUTE, event_ts) - to_minutes(15 * k) AS s
            FROM arrivals JOIN marks USING (arrival), range(4) r(k)) WHERE mark IS NULL OR s + INTERVAL 1 HOUR > mark GROUP BY 1)
        WHERE 100.0::DOUBLE * failed / files > 10""",
    )
    return sql
