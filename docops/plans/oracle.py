"""The same queries as SQL, written independently of the DataFrame code."""

from __future__ import annotations

DOCS = """docs AS (SELECT 'documents_' || lang AS "index", CAST(doc_id AS VARCHAR) AS id, * FROM documents)"""
EVENTS = """ev AS (SELECT 'events' || strftime(ts, '%Y%m%d') AS "index", * FROM events)"""
ORDERS = """od AS (SELECT 'orders' || strftime(o_orderdate, '%Y%m%d') AS "index", * FROM orders)"""
OPS = """ops AS (SELECT event_id AS seq, 'users' AS "index", CAST(user_id AS VARCHAR) AS id, ts,
  CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'index' WHEN 'click' THEN 'update'
    WHEN 'view' THEN 'update' ELSE 'delete' END AS op,
  event_type IN ('signup', 'purchase', 'click') AS has_value,
  event_type IN ('signup', 'purchase', 'view') AS has_k,
  value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CAST(round(value * 100) AS BIGINT) AS bytes FROM events)"""
JUDGED = f"""{OPS}, prior AS (SELECT *, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (
    PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM ops),
  judged AS (SELECT *, CASE
    WHEN op = 'create' AND previous IS NOT NULL AND previous <> 'delete' THEN 'conflict'
    WHEN op = 'update' AND (previous IS NULL OR previous = 'delete') THEN 'missing'
    ELSE 'ok' END AS outcome FROM prior)"""
APPLIED = f"""{JUDGED}, bars AS (SELECT id, max(seq) FILTER (WHERE outcome = 'ok' AND op <> 'update') AS bar,
    max(seq) AS last_seq FROM judged GROUP BY id),
  live AS (SELECT b.* FROM bars b JOIN ops o ON o.seq = b.bar WHERE o.op <> 'delete'),
  applied AS (SELECT 'users' AS "index", l.id, any_value(l.last_seq) AS last_seq,
    arg_max(j.value, j.seq) FILTER (WHERE has_value) AS value, arg_max(j.k, j.seq) FILTER (WHERE has_k) AS k
    FROM live l JOIN judged j ON j.id = l.id AND j.seq >= l.bar AND j.outcome = 'ok' GROUP BY l.id)"""
CATALOG = f"""{EVENTS}, cat AS (SELECT "index", count(*) AS doc_count, epoch_us(min(ts)) // 1000 AS created_millis,
    min(ts) AS created, CASE WHEN "index" < 'events20240111' THEN 'CLOSE' ELSE 'OPEN' END AS state
    FROM ev GROUP BY "index")"""
ALIASES = f"""{EVENTS}, al AS (SELECT DISTINCT 'events' AS alias, "index", CAST(NULL AS VARCHAR) AS filter_field,
    CAST(NULL AS VARCHAR) AS filter_value FROM ev
  UNION ALL SELECT 'events_' || event_type, (SELECT max("index") FROM ev), 'event_type', event_type
    FROM (SELECT DISTINCT event_type FROM events))"""
REQUESTS = f"""{DOCS}, req AS (SELECT doc_id AS position, 0 AS again, 'documents_en' AS "index",
    CAST(doc_id AS VARCHAR) AS id FROM labels
  UNION ALL SELECT doc_id, 1, 'documents_en', CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)"""
LABELLED = f"""{DOCS}, ld AS (SELECT d.*, l.quality, l.toxic FROM docs d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
SHIFT = """cal AS (SELECT DISTINCT 'nation_' || c_nationkey AS alias, 'nation_' || c_nationkey || '_v20240101' AS "index",
    CAST(NULL AS VARCHAR) AS filter_field, CAST(NULL AS VARCHAR) AS filter_value FROM customer
  UNION ALL SELECT s_name, 'suppliers', NULL, NULL FROM supplier
  UNION ALL SELECT c_name, 'nation_' || c_nationkey || '_v20240101', 'c_custkey', CAST(c_custkey AS VARCHAR) FROM customer),
  shifts AS (SELECT DISTINCT 'nation_' || c_nationkey AS base, 'nation_' || c_nationkey || '_v20240102' AS "full" FROM customer),
  old AS (SELECT s.base, s."full", min(a."index") AS old_index FROM shifts s JOIN cal a ON a.alias = s.base GROUP BY 1, 2),
  moved AS (SELECT o.base, 'moved' AS kind, a.alias, o.old_index, o."full" AS "index", a.filter_field, a.filter_value
    FROM old o JOIN cal a ON a."index" = o.old_index),
  named AS (SELECT DISTINCT 'nation_' || c_nationkey AS base, c_mktsegment || '_' || c_nationkey AS alias FROM customer
    UNION SELECT 'nation_' || c_nationkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'),
  fresh AS (SELECT n.base, 'new' AS kind, n.alias, CAST(NULL AS VARCHAR) AS old_index, s."full" AS "index",
      'c_mktsegment' AS filter_field, regexp_extract(n.alias, '^(.*)_', 1) AS filter_value
    FROM named n JOIN shifts s ON s.base = n.base
    WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.base = n.base AND m.alias = n.alias)),
  plan AS (SELECT * FROM moved UNION ALL SELECT * FROM fresh)"""
RETAIN = f"""{CATALOG}, {ORDERS}, known AS (SELECT "index", state FROM cat
    UNION ALL SELECT DISTINCT "index", 'OPEN' FROM od),
  rules(base, "full", delta, min_to_keep) AS (VALUES ('events', 'events20240131', 5, 10),
    ('orders', 'orders20010801', 2, 2)),
  cand AS (SELECT r.base, k."index", r.min_to_keep, count(*) OVER (PARTITION BY r.base) AS n,
      CAST(substr(r."full", 7) AS BIGINT) - CAST(substr(k."index", 7) AS BIGINT) >= r.delta AS el
    FROM known k JOIN rules r ON k."index" LIKE r.base || '%' AND k."index" <> r."full" AND k.state = 'OPEN'),
  ranked AS (SELECT *, count(*) FILTER (WHERE el) OVER (PARTITION BY base ORDER BY "index"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gone FROM cand),
  fate AS (SELECT base, "index", CASE WHEN el AND n > min_to_keep AND n - gone >= min_to_keep
    THEN 'delete' ELSE 'keep' END AS action FROM ranked)"""
TOKENS = r"""list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"""


def _size(value: str, units: str, whole: bool) -> str:
    """Text of a positive number in units of 1024, as a CASE."""
    names = units.split()
    cases = [f"WHEN {value} <= 0 THEN NULL", f"WHEN {value} < 1024 THEN CAST({value} AS VARCHAR) || ' {names[0]}'"]
    for power, name in enumerate(names[1:5], 1):
        scaled = f"(CAST({value} AS DOUBLE) / {1024**power})"
        cases.append(f"WHEN {scaled} <= 1023 THEN CAST(floor({scaled} * 100) / 100 AS VARCHAR) || ' {name}'")
    return f"CASE {' '.join(cases)} END"


def _words(lead: bool, trail: bool) -> str:
    parts = [("d", "day"), ("h", "hour"), ("m", "minute"), ("s", "second")]
    shown = []
    for at, (column, name) in enumerate(parts):
        conditions = ["true"]
        if lead:
            conditions.append("(" + " OR ".join(f"{c} <> 0" for c, _ in parts[: at + 1]) + ")")
        if trail and (lead or at > 0):
            conditions.append("(" + " OR ".join(f"{c} <> 0" for c, _ in parts[at:]) + ")")
        text = f"CAST({column} AS VARCHAR) || CASE WHEN {column} = 1 THEN ' {name}' ELSE ' {name}s' END"
        shown.append(f"CASE WHEN {' AND '.join(conditions)} THEN {text} END")
    return f"concat_ws(' ', {', '.join(shown)})"


def _chunks(full: str) -> str:
    return f"""WITH RECURSIVE r AS (SELECT user_id AS writer, event_id AS seq,
          CAST(round(value * 100) AS BIGINT) AS bytes,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
        walk AS (SELECT writer, seq, bytes, rn, CAST(0 AS BIGINT) AS batch, bytes AS filled, 1 AS held
            FROM r WHERE rn = 1
          UNION ALL SELECT r.writer, r.seq, r.bytes, r.rn, w.batch + CASE WHEN {full} THEN 1 ELSE 0 END,
            CASE WHEN {full} THEN r.bytes ELSE w.filled + r.bytes END, CASE WHEN {full} THEN 1 ELSE w.held + 1 END
          FROM walk w JOIN r ON r.writer = w.writer AND r.rn = w.rn + 1)
        SELECT writer, seq, bytes, batch FROM walk"""


ORACLE: dict[str, str] = {
    "ingest_json_source": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        json_extract_string(props, '$.k') AS dynamic_k FROM events""",
    "ingest_rejected": """SELECT event_id, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0
        THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, event_id % 5 = 0 OR event_id % 7 = 0 AS rejected
        FROM events""",
    "field_coverage_documents": f"""WITH {APPLIED}, c AS (SELECT count(*) AS n, count(value) AS v, count(k) AS k FROM applied),
        p AS (SELECT 'value' AS path, v AS docs, n FROM c UNION ALL SELECT 'k', k, n FROM c
          UNION ALL SELECT 'author', 0, n FROM c)
        SELECT path, docs, round(docs * 100.0 / CAST(n AS DOUBLE), 6) AS percent FROM p""",
    "rollover_route": f"""WITH {EVENTS} SELECT event_id, "index" FROM ev""",
    "bulk_ndjson_export": f"""WITH {OPS}, src AS (SELECT *, '{{' || concat_ws(',',
          CASE WHEN has_value THEN '"value":"' || CAST(value AS VARCHAR) || '"' END,
          CASE WHEN has_k THEN '"k":"' || CAST(k AS VARCHAR) || '"' END) || '}}' AS source FROM ops)
        SELECT seq, '{{"' || op || '":{{"_index":"users","_id":"' || id || '"}}}}' || chr(10) || CASE op
          WHEN 'delete' THEN '' WHEN 'update' THEN '{{"doc":' || source || '}}' || chr(10)
          ELSE source || chr(10) END AS body FROM src""",
    "bulk_chunk_by_count": """SELECT user_id AS writer, event_id AS seq,
        (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS batch FROM events""",
    "bulk_chunk_by_volume": _chunks("w.filled >= 10000"),
    "bulk_chunk": _chunks("w.filled >= 10000 OR w.held >= 5"),
    "auto_id": """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR)
        ELSE sha256(CAST(event_id AS VARCHAR) || '|' || props) END AS id FROM events""",
    "scroll_pages": f"""WITH {DOCS} SELECT doc_id, "index",
        (row_number() OVER (ORDER BY doc_id) - 1) // 79 AS page FROM docs""",
    "scroll_stats": """SELECT CAST(sum(n) AS BIGINT) AS hits, count(*) AS pages, min(n) AS least, max(n) AS most FROM
        (SELECT count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 79 AS page FROM documents)
        GROUP BY page)""",
    "scroll_resumed": """SELECT l_orderkey, l_linenumber, l_extendedprice, (row_number() OVER (ORDER BY
        l_extendedprice DESC, l_orderkey, l_linenumber) - 1) // 100 AS page FROM lineitem""",
    "compact_index": f"""WITH {EVENTS} SELECT "index", count(*) AS docs, CAST(1 AS BIGINT) AS files FROM ev
        WHERE "index" = 'events20240130' GROUP BY 1""",
    "get_ids": "SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang = 'fr'",
    "doc_get": f"""WITH {DOCS} SELECT "index", id, text, CAST(-1 AS FLOAT) AS score FROM docs
        WHERE "index" = 'documents_en' AND id = '1'""",
    "doc_multi_get": f"""WITH {REQUESTS} SELECT r.position, r.again, r."index", r.id, d.source, d.n_chars,
        d.id IS NOT NULL AS found, CAST(-1 AS FLOAT) AS score
        FROM req r LEFT JOIN docs d ON d."index" = r."index" AND d.id = r.id""",
    "keyed_multi_get": f"""WITH {REQUESTS} SELECT r.position, r.again, r."index", r.id, d.source, d.n_chars,
        d.id IS NOT NULL AS found, CAST(-1 AS FLOAT) AS score
        FROM req r LEFT JOIN docs d ON d."index" = r."index" AND d.id = r.id WHERE r.again = 1""",
    "keyed_exists": f"""WITH {REQUESTS} SELECT r.*, EXISTS (SELECT 1 FROM docs d
        WHERE d."index" = r."index" AND d.id = r.id) AS "exists" FROM req r WHERE r.again = 1""",
    "doc_exists": f"""WITH {REQUESTS} SELECT r.*, EXISTS (SELECT 1 FROM docs d
        WHERE d."index" = r."index" AND d.id = r.id) AS "exists" FROM req r""",
    "searchable_docs": "SELECT count(*) AS docs FROM documents WHERE lang = 'en'",
    "search_term": f"""WITH {DOCS} SELECT "index", id FROM docs WHERE lang = 'de'""",
    "search_exists": f"""WITH {LABELLED} SELECT "index", id, CAST(1 AS FLOAT) AS score FROM ld
        WHERE quality IS NOT NULL""",
    "search_match_normalized": """SELECT p_partkey, p_name FROM part
        WHERE lower(trim(p_name)) = 'small ring'""",
    "search_field_query": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_quantity = 23 AND l_returnflag = 'A'""",
    "search_analyzed_term": f"""WITH {DOCS} SELECT "index", id FROM docs
        WHERE list_has_any({TOKENS}, ['that', 'with'])""",
    "search_wildcard": f"""WITH {DOCS} SELECT "index", id FROM docs
        WHERE len(list_filter({TOKENS}, lambda t: regexp_full_match(t, 're.t.*ing.*'))) > 0""",
    "search_sorted_page": """SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20""",
    "search_total": """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS total
        FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "search_aggregate": """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity,
        round(avg(l_extendedprice), 4) AS mean_price, max(l_extendedprice) AS max_price
        FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1, 2""",
    "search_multi_index": f"""WITH {EVENTS} SELECT "index", event_id FROM ev
        WHERE "index" IN ('events20240105', 'events20240117')""",
    "search_projection": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH'",
    "search_empty_page": """SELECT CAST(0 AS BIGINT) AS hits, count(*) AS total, false AS has_result
        FROM orders WHERE o_orderstatus = 'F'""",
    "search_deep_page": """SELECT l_extendedprice, l_orderkey, l_linenumber FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25 OFFSET 55000""",
    "search_deep_page_ties": """SELECT l_quantity FROM lineitem ORDER BY l_quantity DESC LIMIT 40 OFFSET 30000""",
    "bulk_index_last_wins": f"""WITH {OPS} SELECT "index", id, max(seq) AS seq, arg_max(value, seq) AS value,
        arg_max(k, seq) AS k FROM ops WHERE op = 'index' GROUP BY 1, 2""",
    "bulk_create_if_absent": f"""WITH {JUDGED} SELECT seq, "index", id FROM judged
        WHERE op = 'create' AND outcome = 'ok'""",
    "bulk_partial_update": f"""WITH {APPLIED} SELECT * FROM applied
        WHERE id IN (SELECT id FROM ops WHERE op = 'update')""",
    "bulk_delete": f"""WITH {APPLIED} SELECT 'users' AS "index", b.id, a.id IS NULL AS deleted, b.last_seq, a.value, a.k
        FROM bars b LEFT JOIN applied a ON a.id = b.id WHERE b.id IN (SELECT id FROM ops WHERE op = 'delete')""",
    "delete_by_id": f"""WITH {LABELLED} SELECT "index", id FROM ld WHERE toxic IS DISTINCT FROM 1""",
    "bulk_apply": f"""WITH {APPLIED} SELECT * FROM applied""",
    "bulk_item_outcome": f"""WITH {JUDGED} SELECT seq, id, op, outcome FROM judged""",
    "bulk_fail_on_error": f"""WITH {JUDGED} SELECT count(*) AS submitted,
        count(*) FILTER (WHERE outcome = 'ok') AS succeeded, count(*) FILTER (WHERE outcome <> 'ok') AS failed,
        count(*) FILTER (WHERE outcome = 'conflict') AS conflicts,
        count(*) FILTER (WHERE outcome = 'missing') AS missing FROM judged""",
    "update_with_upsert": """WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer
          WHERE c_mktsegment = 'BUILDING'),
        o AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey, CAST(o_totalprice AS VARCHAR) AS price,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
        u AS (SELECT id, arg_min(price, o_orderkey) AS first_price, arg_max(price, o_orderkey) AS last_price,
          max(rn) AS n FROM o GROUP BY id)
        SELECT coalesce(b.id, u.id) AS id, b.id IS NOT NULL AS live, b.c_name AS name,
          CASE WHEN b.id IS NULL THEN u.first_price END AS first_price,
          CASE WHEN b.id IS NOT NULL OR u.n > 1 THEN u.last_price END AS last_price
        FROM base b FULL JOIN u ON u.id = b.id""",
    "enabled_only": """SELECT event_id AS seq, 'events_' || event_type AS "index" FROM events
        WHERE event_type <> 'error'""",
    "index_catalog": f"""WITH {CATALOG} SELECT "index", doc_count, created_millis, state FROM cat""",
    "index_state": f"""WITH {CATALOG}, {DOCS}, wanted AS (SELECT "index" FROM cat
          UNION ALL SELECT DISTINCT "index" FROM docs)
        SELECT w."index", c.state IS NOT NULL AS "exists", c.state, coalesce(c.state = 'OPEN', false) AS is_open,
          coalesce(c.state = 'CLOSE', false) AS is_closed FROM wanted w LEFT JOIN cat c ON c."index" = w."index" """,
    "closed_older_than": f"""WITH {CATALOG} SELECT "index" FROM cat
        WHERE state = 'CLOSE' AND created < TIMESTAMP '2024-01-06'""",
    "purge_closed": f"""WITH {CATALOG} SELECT "index", event_id FROM ev WHERE "index" NOT IN (SELECT "index" FROM cat
        WHERE state = 'CLOSE' AND created < TIMESTAMP '2024-01-06')""",
    "open_close_scan": f"""WITH {CATALOG} SELECT "index", event_id FROM ev WHERE "index" = 'events20240103'
        OR "index" IN (SELECT "index" FROM cat WHERE state = 'OPEN')""",
    "routed_open_scan": f"""WITH {CATALOG} SELECT "index", event_id FROM ev
        WHERE "index" IN (SELECT "index" FROM cat WHERE state = 'OPEN')""",
    "drop_index": f"""WITH {EVENTS} SELECT "index", event_id FROM ev
        WHERE "index" NOT IN ('events20240107', 'events20240108', 'events19990101')""",
    "resolve_alias": f"""WITH {ALIASES} SELECT DISTINCT "index" FROM al WHERE alias = 'events'""",
    "most_recent_index": f"""WITH {ALIASES} SELECT alias, CASE WHEN alias = 'events' THEN max("index") ELSE alias END
        AS "index" FROM al GROUP BY alias""",
    "aliases_of_index": f"""WITH {ALIASES} SELECT alias, filter_field, filter_value FROM al
        WHERE "index" = 'events20240130'""",
    "shift_alias": f"""WITH {SHIFT} SELECT * FROM plan""",
    "shift_alias_table": f"""WITH {SHIFT} SELECT alias, "index", filter_field, filter_value FROM plan
        UNION ALL SELECT * FROM cal WHERE "index" NOT IN (SELECT old_index FROM old)""",
    "shift_versions": f"""WITH {SHIFT},
        after AS (SELECT alias, "index", filter_field FROM plan UNION ALL
            SELECT alias, "index", filter_field FROM cal WHERE "index" NOT IN (SELECT old_index FROM old)),
        known AS (SELECT "index" FROM cal UNION SELECT "full" FROM shifts)
        SELECT k."index", CASE WHEN k."index" IN (SELECT old_index FROM old) THEN 'CLOSE' ELSE 'OPEN' END AS state,
            count(a.alias) AS aliases, count(a.filter_field) AS filtered, CAST(1 AS BIGINT) AS version
        FROM known k LEFT JOIN after a ON a."index" = k."index" GROUP BY k."index" """,
    "shift_close_old": f"""WITH {CATALOG} SELECT "index", CASE WHEN "index" = 'events20240130' THEN 'OPEN'
        ELSE 'CLOSE' END AS state FROM cat""",
    "filtered_alias_scan": f"""WITH {ALIASES} SELECT a.alias, e."index", e.event_id FROM ev e
        JOIN al a ON a."index" = e."index" WHERE a.filter_field IS NULL OR e.event_type = a.filter_value""",
    "alias_scan_one": f"""WITH {EVENTS} SELECT "index", event_id FROM ev WHERE event_type = 'click'
        AND "index" = (SELECT max("index") FROM ev)""",
    "prune_index": f"""WITH {RETAIN} SELECT base, "index", action FROM fate""",
    "prune_result": f"""WITH {RETAIN} SELECT base, 'SUCCESS' AS state, count(*) AS candidates,
          count(*) FILTER (WHERE action = 'delete') AS deleted FROM fate GROUP BY base
        UNION ALL SELECT 'unknown', 'NONE', CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    "prune_rows": f"""WITH {RETAIN} SELECT "index", event_id FROM ev
        WHERE "index" NOT IN (SELECT "index" FROM fate WHERE action = 'delete')""",
    "most_recent_document": "SELECT epoch_us(max(ts)) // 1000 AS millis FROM events",
    "most_recent_by_index": f"""WITH {EVENTS} SELECT "index", epoch_us(max(ts)) // 1000 AS millis FROM ev GROUP BY 1""",
    "field_coverage": f"""WITH {LABELLED}, c AS (SELECT count(*) AS n, count(doc_id) AS a, count(text) AS b,
          count(lang) AS c, count(source) AS d, count(n_chars) AS e, count(quality) AS f, count(toxic) AS g FROM ld),
        p AS (SELECT 'doc_id' AS path, a AS docs, n FROM c UNION ALL SELECT 'text', b, n FROM c
          UNION ALL SELECT 'lang', c, n FROM c UNION ALL SELECT 'source', d, n FROM c
          UNION ALL SELECT 'n_chars', e, n FROM c UNION ALL SELECT 'quality', f, n FROM c
          UNION ALL SELECT 'toxic', g, n FROM c UNION ALL SELECT 'author', 0, n FROM c)
        SELECT path, docs, round(docs * 100.0 / CAST(n AS DOUBLE), 6) AS percent FROM p""",
    "field_coverage_summary": "SELECT CAST(8 AS BIGINT) AS fields, CAST(1 AS BIGINT) AS unused",
    "observed_paths": """WITH p AS (SELECT unnest(CASE event_id % 4 WHEN 0 THEN ['k', 'person.name', 'person.n']
          WHEN 1 THEN ['k', 'person.name', 'person.n'] WHEN 2 THEN ['deep.a.b.c', 'deep.a.b.d.e.f']
          ELSE ['k', 'person'] END) AS path FROM events) SELECT path, count(*) AS docs FROM p GROUP BY path""",
    "ingest_json_lists": """WITH e AS (SELECT event_id, event_id % 4 AS s, event_type AS t,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
        SELECT event_id, CASE s WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 END AS k_count,
          CAST(CASE s WHEN 0 THEN k WHEN 1 THEN 2 * k WHEN 2 THEN 0 END AS BIGINT) AS k_sum,
          CASE s WHEN 0 THEN t WHEN 1 THEN t || ',x,' || t WHEN 2 THEN '' END AS names,
          CAST(CASE s WHEN 0 THEN k WHEN 1 THEN 3 * k WHEN 2 THEN 0 END AS BIGINT) AS n_sum FROM e""",
    "observed_fields": """SELECT field, count(*) AS docs FROM (SELECT unnest(json_keys(props)) AS field FROM events)
        GROUP BY field""",
    "stream_bulk_apply": f"""WITH {APPLIED} SELECT * FROM applied""",
    "stream_flush_by_size": f"""WITH {APPLIED} SELECT *, true AS several, CAST(0 AS BIGINT) AS late FROM applied""",
    "stream_flush_by_bytes": f"""WITH {APPLIED} SELECT *, true AS several, CAST(0 AS BIGINT) AS late FROM applied""",
    "stream_fold": f"""WITH {APPLIED} SELECT *, CAST(1 AS BIGINT) AS rows_per_key, (SELECT count(*) FROM ops) AS late
        FROM applied""",
    "stream_ingest_metrics": f"""WITH {JUDGED} SELECT CAST(0 AS BIGINT) AS batch, count(*) AS submitted,
        count(*) FILTER (WHERE outcome = 'ok') AS succeeded, count(*) FILTER (WHERE outcome <> 'ok') AS failed,
        CAST(0 AS BIGINT) AS late FROM judged""",
    "bulk_report": f"""WITH {JUDGED}, s AS (SELECT id, count(*) AS submitted,
          count(*) FILTER (WHERE outcome = 'ok') AS succeeded, count(*) FILTER (WHERE outcome <> 'ok') AS failed,
          CAST(sum(bytes) AS BIGINT) AS bytes, max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000) AS elapsed
          FROM judged GROUP BY id)
        SELECT *, round(succeeded * 1000.0 / nullif(CAST(elapsed AS DOUBLE), 0), 8) AS docs_per_second,
          round(bytes * 1000.0 / nullif(CAST(elapsed AS DOUBLE), 0), 8) AS bytes_per_second,
          round(bytes / (succeeded + CAST(1 AS DOUBLE)), 8) AS mean_bytes FROM s""",
    "throughput_blocks": """WITH r AS (SELECT user_id AS writer,
          CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS took, CAST(round(value * 100) AS BIGINT) AS bytes,
          (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 8 AS block FROM events),
        b AS (SELECT writer, block, avg(took) AS mt, min(took) AS nt, max(took) AS xt, avg(bytes) AS ab,
          min(bytes) AS nb, max(bytes) AS xb, avg(bytes) / avg(took) AS tp FROM r GROUP BY 1, 2 HAVING count(*) = 8),
        d AS (SELECT *, coalesce(tp - lag(tp) OVER (PARTITION BY writer ORDER BY block), 0) AS delta FROM b)
        SELECT writer, block, nt AS min_took, xt AS max_took, nb AS min_size, xb AS max_size,
          round(mt, 6) AS avg_took, round(ab, 6) AS avg_size, round(tp, 6) AS throughput, round(delta, 6) AS delta,
          round(delta * 100 / tp, 6) AS delta_percent FROM d""",
    "search_report": """WITH q AS (SELECT CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup'
          THEN 'timeout' WHEN event_type = 'view' OR json_extract_string(props, '$.k') = '0' THEN 'empty'
          ELSE 'succeeded' END AS o FROM events)
        SELECT count(*) AS total, count(*) FILTER (WHERE o = 'succeeded') AS succeeded,
          count(*) FILTER (WHERE o = 'empty') AS "empty", count(*) FILTER (WHERE o = 'failed') AS failed,
          count(*) FILTER (WHERE o = 'timeout') AS timeout FROM q""",
    "format_sizes": f"""WITH v AS (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) * l_orderkey AS size,
          CAST(floor(l_extendedprice) AS BIGINT) AS speed, CAST(floor(l_quantity) AS BIGINT) AS rate FROM lineitem)
        SELECT l_orderkey, l_linenumber, {_size('size', 'B kB MB GB TB', True)} AS size_text,
          {_size('l_extendedprice', 'B kB MB GB TB', False)} AS price_text,
          {_size('speed', 'B/s kB/s MB/s GB/s TB/s', True)} AS speed_text,
          {_size('rate', 'dps kdps Mdps Gdps Tdps', True)} AS docs_text FROM v""",
    "format_duration": """WITH v AS (SELECT event_id, CAST(round(value * 1000000) AS BIGINT) AS t FROM events)
        SELECT event_id, (t // 86400000) || 'd ' || (t // 3600000 % 24) || ':' || (t // 60000 % 60) || ':' ||
          (t // 1000 % 60) || '.' || lpad(CAST(t % 1000 AS VARCHAR), 3, '0') AS full_text,
          (t // 3600000) || ' h ' || (t % 3600000) AS part_text FROM v""",
    "format_duration_words": f"""WITH v AS (SELECT event_id, CAST(round(value * 1000000) AS BIGINT) // 60000 AS t
          FROM events),
        p AS (SELECT event_id, t // 1440 AS d, t // 60 % 24 AS h, t % 60 AS m, CAST(0 AS BIGINT) AS s FROM v)
        SELECT event_id, {_words(True, True)} AS words_11, {_words(True, False)} AS words_10,
          {_words(False, True)} AS words_01, {_words(False, False)} AS words_00 FROM p""",
    "matching_page": f"""WITH {DOCS}, f AS (SELECT * FROM docs WHERE list_has_any({TOKENS}, ['that']))
        SELECT "index", id, doc_id, n_chars, (SELECT count(*) FROM f) AS total FROM f
        ORDER BY n_chars DESC, doc_id LIMIT 10""",
}

for _name in ("bulk_apply", "bulk_item_outcome", "bulk_chunk", "bulk_chunk_by_count", "throughput_blocks"):
    ORACLE[f"{_name}_split"] = ORACLE[_name]

ORACLE["routed_multi_index"] = ORACLE["search_multi_index"]
