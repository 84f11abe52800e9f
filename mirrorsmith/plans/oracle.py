"""Equivalent SQL for the registered queries (DuckDB dialect).

Each statement computes the expected result straight from the given tables,
independently of the Spark code path (no JSON pages, no snapshots): the
oracle for a decoding query applies the empty-value rules in SQL, the oracle
for a merge query is a full outer join, and so on.
"""

from __future__ import annotations

from mirrorsmith.functions.constants import KINDS
from mirrorsmith.plans import queries as q
from mirrorsmith.sources.tables import GUID_TAG, TABLE_NAMES


def _guid(x: str) -> str:
    h = f"('{GUID_TAG}' || substr(lower(lpad(hex({x}), 32, '0')), 2))"
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||"
            f"substr({h},17,4)||'-'||substr({h},21,12))")


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


_KINDS_VALUES = ", ".join(f"('{k}', '{n}', {i})" for i, (k, n) in enumerate(KINDS))
_KINDS_CTE = f"kinds(kind, name, idx) AS (VALUES {_KINDS_VALUES})"
_N_KINDS = len(KINDS)

# FIXED VALUES: source types and their engine types.
_ENGINE_CASE = """CASE {t}
    WHEN 'Edm.Guid' THEN 'uuid' WHEN 'Edm.Int16' THEN 'int2' WHEN 'Edm.Int32' THEN 'int4'
    WHEN 'Edm.Int64' THEN 'int8' WHEN 'Edm.Double' THEN 'numeric' WHEN 'Edm.DateTime' THEN 'timestamp'
    WHEN 'Edm.Boolean' THEN 'bool' WHEN 'Edm.Binary' THEN 'bytea'
    ELSE CASE WHEN {t} LIKE 'Collection(%' THEN 'section[]'
              WHEN {t} = 'StandardODATA.TypeDescription' THEN 'varchar[]' ELSE 'text' END END"""

_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLE_NAMES)

_STATES = """cur AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CAST(o_orderkey AS VARCHAR) || '-false' AS ver
  FROM orders WHERE o_orderkey % 10 <> 0),
src AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 10 = 3 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 10 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority,
         CAST(o_orderkey AS VARCHAR) || '-' || CASE WHEN o_orderkey % 10 = 2 THEN 'true' ELSE 'false' END AS ver
  FROM orders WHERE o_orderkey % 10 <> 1)"""

_CHANGES = _STATES + """,
changes AS (
  SELECT COALESCE(s.o_orderkey, c.o_orderkey) AS o_orderkey,
         c.o_orderstatus AS old_status, s.o_orderstatus AS new_status,
         c.o_totalprice AS old_price, s.o_totalprice AS new_price, c.ver AS old_ver, s.ver AS new_ver,
         CASE WHEN c.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete'
              WHEN s.ver IS DISTINCT FROM c.ver THEN 'update' ELSE 'same' END AS action,
         (s.o_custkey IS DISTINCT FROM c.o_custkey OR s.o_orderstatus IS DISTINCT FROM c.o_orderstatus
          OR s.o_totalprice IS DISTINCT FROM c.o_totalprice OR s.o_orderdate IS DISTINCT FROM c.o_orderdate
          OR s.o_orderpriority IS DISTINCT FROM c.o_orderpriority OR s.ver IS DISTINCT FROM c.ver) AS value_changed
  FROM cur c FULL OUTER JOIN src s ON s.o_orderkey = c.o_orderkey)"""

_LINE_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
               "l_returnflag, l_linestatus, l_shipdate")

_MEMBERS = """members AS (
  SELECT ref, row_number() OVER (ORDER BY ref) AS pos FROM (SELECT DISTINCT o_orderpriority AS ref FROM orders)),
existing AS (
  SELECT ref, pos * 10 AS ord FROM members WHERE pos > 1
  UNION ALL SELECT '0-WITHDRAWN-' || ref AS ref, 5 AS ord FROM members WHERE pos = 1)"""

_EVENT_TYPE = f"""CASE event_type
    WHEN 'click' THEN 'StandardODATA.' || (SELECT kind FROM kinds WHERE idx = user_id % {_N_KINDS}) || '_Obj' || CAST(user_id % 7 AS VARCHAR)
    WHEN 'signup' THEN 'StandardODATA.Пол' || CAST(user_id % 3 AS VARCHAR)
    WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'StandardODATA.Undefined' ELSE '' END
    WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'Edm.Int64' ELSE 'Edm.Guid' END
    ELSE NULL END"""

_EVENT_REF = f"""CASE WHEN event_type IN ('click', 'view')
         THEN (SELECT kind FROM kinds WHERE idx = user_id % {_N_KINDS}) || 'Ref.Obj' || CAST(user_id % 5 AS VARCHAR)
     WHEN event_type = 'signup' THEN 'EnumRef.Пол' || CAST(user_id % 3 AS VARCHAR)
     ELSE 'Edm.' || event_type END"""

_REF_LOCAL = """COALESCE(
    (SELECT k.name || '.' || substr(ref_src, length(k.kind) + 5) FROM kinds k WHERE starts_with(ref_src, k.kind || 'Ref.')),
    CASE WHEN starts_with(ref_src, 'EnumRef.') THEN 'Перечисление.' || substr(ref_src, 9) ELSE ref_src END)"""


# FIXED VALUES: one step of the abbreviation.
def _abbrev(x: str) -> str:
    return f"regexp_replace({x}, '(.*)([А-Я]|[A-Z]|_[а-я]|_[a-z])([а-я]+|[a-z]+)(.*)', '\\1\\2\\4')"


_ABBREV_STEPS = 6


def _abbreviate_sql() -> str:
    name = ("array_to_string(list_transform(string_split(p_name, ' '), "
            "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '') || 'Информация'")
    ctes = [f"s0 AS (SELECT p_partkey, {name} AS name, {name} AS c0 FROM part)"]
    for i in range(1, _ABBREV_STEPS + 1):
        ctes.append(f"s{i} AS (SELECT *, {_abbrev(f'c{i - 1}')} AS c{i} FROM s{i - 1})")
    n = " + ".join(f"CASE WHEN c{i} <> c{i - 1} THEN 1 ELSE 0 END" for i in range(1, _ABBREV_STEPS + 1))
    fit = " ".join(f"WHEN strlen(c{i}) <= {q.SHORT_NAME_BYTES} THEN c{i}" for i in range(_ABBREV_STEPS + 1))
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT p_partkey, name, c{_ABBREV_STEPS} AS shortest, CAST(1 + {n} AS BIGINT) AS n_candidates,
       CASE {fit} ELSE NULL END AS short_name, CAST(strlen(name) AS BIGINT) AS name_bytes
FROM s{_ABBREV_STEPS}""")


def _chunks(lines: str) -> str:
    """The lines' chunks: each order's lines, in order, so many at a time."""
    return f"""
WITH placed AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS n FROM {lines} l)
SELECT l_orderkey AS o_orderkey, n // {q.CHUNK_LINES} AS chunk, COUNT(*) AS n_lines,
  string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY n) AS part_keys,
  CAST(SUM(CAST(l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS sum_qty
FROM placed GROUP BY l_orderkey, n // {q.CHUNK_LINES}"""


def oracle_sql() -> dict[str, str]:
    step = (q.DEDUP_FETCH_SIZE + 1) // 2
    fetch = q.default_fetch_size()
    fstep = (fetch + 1) // 2
    sql = {
        "json_to_columns": """
SELECT event_id,
  COALESCE(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k,
  COALESCE(CAST(json_extract_string(props, '$.z') AS DOUBLE), 0.0) AS z_num,
  COALESCE(CAST(json_extract_string(props, '$.zb') AS BOOLEAN), false) AS z_bool,
  COALESCE(json_extract_string(props, '$.zt'), '') AS z_text
FROM events""",
        "json_defaults": f"""
SELECT event_id,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE {_guid('user_id')} END AS user_guid,
  CASE WHEN event_type = 'error' THEN NULL ELSE {_ts("date_trunc('second', ts + INTERVAL 500 MILLISECOND)")} END AS period,
  CASE WHEN event_type = 'view' THEN 0.0 ELSE COALESCE(value, 0.0) END AS value,
  CASE WHEN event_type = 'signup' THEN false ELSE COALESCE(event_type = 'purchase', false) END AS success,
  CASE WHEN event_type = 'click' THEN '' ELSE COALESCE(event_type, '') END AS kind,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS data
FROM events""",
        "zero_to_null": f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN '0001-01-01 00:00:00' ELSE {_ts('o_orderdate')} END AS key_date,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_ts('o_orderdate')} END AS order_date,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_guid('o_custkey')} END AS customer_guid,
  CASE WHEN o_orderkey % 7 = 0 THEN '0001-01-01 00:00:00' ELSE {_ts('o_orderdate')} END AS line_date,
  CASE WHEN o_orderkey % 7 = 0 THEN '00000000-0000-0000-0000-000000000000' ELSE {_guid('o_custkey')} END
    AS line_customer_guid
FROM orders""",
        "value_any": f"""
WITH {_KINDS_CTE},
src AS (SELECT event_id, CAST(user_id AS VARCHAR) AS v, {_EVENT_TYPE} AS t FROM events)
SELECT event_id,
  CASE WHEN v IS NULL OR t IS NULL OR t = '' OR t = 'StandardODATA.Undefined' THEN NULL ELSE v END AS any_value,
  CASE WHEN v IS NULL OR t IS NULL OR t = '' OR t = 'StandardODATA.Undefined' THEN 'null'
       WHEN starts_with(t, 'StandardODATA.') THEN COALESCE(
         (SELECT k.name || '.' || substr(t, 15 + length(k.kind) + 1) FROM kinds k
           WHERE starts_with(substr(t, 15), k.kind || '_')),
         'Перечисление.' || substr(t, 15))
       ELSE {_ENGINE_CASE.format(t='t')} END AS any_type
FROM src""",
        "type_ref": f"""
WITH {_KINDS_CTE},
src AS (SELECT event_id, event_type, {_EVENT_REF} AS ref_src FROM events),
mapped AS (SELECT event_id, event_type, ref_src, {_REF_LOCAL} AS ref_local FROM src)
SELECT event_id, ref_src, ref_local,
  CASE WHEN event_type = 'error' THEN '' ELSE ref_local || '|Перечисление.Пол|string' END AS type_list
FROM mapped""",
        "map_types": f"""
WITH src AS (
  SELECT event_id, user_id % 3 = 0 AS composite,
    CASE event_type
      WHEN 'click' THEN 'Edm.Guid'
      WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'Edm.Int64' ELSE 'Edm.Int16' END
      WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'Edm.Double' ELSE 'Edm.Boolean' END
      WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'Edm.DateTime' ELSE 'StandardODATA.TypeDescription' END
      ELSE CASE WHEN user_id % 2 = 0 THEN 'Collection(StandardODATA.Catalog_X_Y_RowType)' ELSE 'Edm.String' END
    END AS type_src
  FROM events)
SELECT event_id, type_src, composite,
  CASE WHEN composite THEN 'value_any' ELSE {_ENGINE_CASE.format(t='type_src')} END AS engine_type
FROM src""",
        "abbreviate_name": _abbreviate_sql(),
        "key_filter": f"""
SELECT o_orderkey,
  'Ref_Key eq guid''' || {_guid('o_orderkey')} || ''' and Date eq datetime''' ||
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || ''' and Priority eq ''' ||
  replace(o_orderpriority || '''s', '''', '''''') || ''' and Customer eq ' || CAST(o_custkey AS VARCHAR) AS filter
FROM orders""",
        "mask_url": """
SELECT page_id,
  regexp_replace(
    regexp_replace(url, '^([a-z]+://)', '\\1user' || CAST(page_id AS VARCHAR) || ':secret' || CAST(page_id AS VARCHAR) || '@'),
    '^([A-Za-z][A-Za-z0-9+.-]*://[^:/@]*:)[^@/]*@', '\\1[Пароль]@') AS logged_url
FROM pages""",
        "plan_pages": f"""
WITH counts AS ({_COUNTS}),
sizes AS (SELECT table_name, row_count, fs AS fetch_size FROM counts, (VALUES (100), (1000)) v(fs)),
planned AS (
  SELECT *, (fetch_size + 1) // 2 AS step,
         CASE WHEN row_count < fetch_size THEN 1 ELSE (row_count - fetch_size) // ((fetch_size + 1) // 2) + 2 END AS n_pages
  FROM sizes),
req AS (SELECT *, unnest(generate_series(0, n_pages - 1)) AS page_no FROM planned)
SELECT table_name, CAST(fetch_size AS BIGINT) AS fetch_size, CAST(row_count AS BIGINT) AS row_count,
  CAST(COUNT(*) AS BIGINT) AS n_pages,
  CAST(SUM(LEAST(fetch_size, GREATEST(0, row_count - page_no * step))) AS BIGINT) AS rows_transferred,
  CAST(MAX(page_no * step) AS BIGINT) AS last_skip,
  '/InfoBase/odata/standard.odata/Catalog_' || table_name || '?$orderby=Ref_Key&$skip=' ||
    CAST(MAX(page_no * step) AS VARCHAR) || '&$top=' || CAST(fetch_size AS VARCHAR) AS last_url
FROM req GROUP BY table_name, fetch_size, row_count""",
        "dedup_first_page": f"""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events),
placed AS (SELECT *, CAST(GREATEST(0, CEIL((n - {q.DEDUP_FETCH_SIZE} + 1) / {step}.0)) AS BIGINT) AS page_no FROM numbered)
SELECT event_id, page_no, CAST(n - page_no * {step} AS BIGINT) AS pos,
  CASE WHEN event_type = 'view' THEN 0.0 ELSE COALESCE(value, 0.0) END AS value,
  CASE WHEN event_type = 'click' THEN '' ELSE COALESCE(event_type, '') END AS kind
FROM placed""",
        "build_sections": """
SELECT o.o_orderkey, COUNT(l.l_orderkey) AS n_lines,
  CAST(ROUND(COALESCE(SUM(CAST(l.l_quantity AS DECIMAL(38,10))), 0), 2) AS DOUBLE) AS sum_qty,
  CAST(ROUND(COALESCE(SUM(CAST(l.l_extendedprice AS DECIMAL(38,10))), 0), 2) AS DOUBLE) AS sum_price,
  COUNT(l.l_orderkey) AS last_line_no,
  true AS master_key_ok
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey""",
        "explode_section": f"""
SELECT l_orderkey AS o_orderkey,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS line_no,
  l_partkey, l_quantity AS quantity, l_extendedprice AS amount, l_returnflag AS return_flag,
  {_ts('l_shipdate')} AS ship_date
FROM lineitem""",
        "section_field_array": f"""
SELECT o.o_orderkey,
  COALESCE(string_agg(CAST(l.l_partkey AS VARCHAR), ',' ORDER BY {', '.join('l.' + c.strip() for c in _LINE_ORDER.split(','))}), '') AS part_keys,
  COUNT(l.l_orderkey) AS n_parts
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey""",
        "section_contains": """
SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines
FROM lineitem GROUP BY l_orderkey
HAVING bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'R')""",
        "section_contains_indexed": """
WITH p AS (SELECT l_partkey AS p FROM lineitem ORDER BY l_extendedprice DESC, l_partkey DESC LIMIT 1)
SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines
FROM lineitem WHERE l_orderkey % 10 <> 1 GROUP BY l_orderkey
HAVING bool_or(l_partkey IN (SELECT p FROM p))""",
        "section_chunks": _chunks("lineitem"),
        "section_chunks_refresh": _chunks("""(SELECT * REPLACE (l_quantity + CASE WHEN l_orderkey % 10 = 2 THEN 1 ELSE 0 END AS l_quantity)
  FROM lineitem WHERE l_orderkey % 10 <> 1)"""),
        "section_chunks_explode": f"""
SELECT l_orderkey AS o_orderkey,
  (row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1) // {q.CHUNK_LINES} AS chunk,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS line_no, l_partkey, l_quantity AS quantity
FROM lineitem""",
        "section_chunks_contain": """
SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines,
  CAST(ROUND(SUM(CAST(l_quantity AS DECIMAL(38,10))), 2) AS DOUBLE) AS sum_qty
FROM lineitem GROUP BY l_orderkey
HAVING bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'R')""",
        "sales_view_refresh": f"""
WITH {_STATES}
SELECT o_custkey AS customer, COUNT(*) AS n_orders, CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(38,10))), 2) AS DOUBLE) AS total
FROM src GROUP BY o_custkey""",
        "deferred_fk_violations": """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 1)""",
        "refresh_counts": f"""
WITH {_CHANGES},
c AS (SELECT COUNT(*) FILTER (WHERE action = 'insert') AS i, COUNT(*) FILTER (WHERE action = 'update') AS u,
             COUNT(*) FILTER (WHERE action = 'delete') AS d, COUNT(*) FILTER (WHERE action = 'same') AS s FROM changes)
SELECT 1::BIGINT AS run, i AS n_insert, u AS n_update, d AS n_delete, s AS n_same, i + u + s AS row_count, i + u + d > 0 AS wrote, true AS timed FROM c
UNION ALL SELECT 2, 0, 0, 0, i + u + s, i + u + s, false, true FROM c""",
        "merge_full": f"""
WITH {_STATES}
SELECT s.o_orderkey,
  CASE WHEN c.o_orderkey IS NULL OR s.ver IS DISTINCT FROM c.ver THEN s.ver ELSE c.ver END AS ver,
  CASE WHEN c.o_orderkey IS NULL OR s.ver IS DISTINCT FROM c.ver THEN s.o_orderstatus ELSE c.o_orderstatus END AS o_orderstatus,
  CASE WHEN c.o_orderkey IS NULL OR s.ver IS DISTINCT FROM c.ver THEN s.o_totalprice ELSE c.o_totalprice END AS o_totalprice,
  CASE WHEN c.o_orderkey IS NULL THEN 'insert' WHEN s.ver IS DISTINCT FROM c.ver THEN 'update' ELSE 'same' END AS action
FROM src s LEFT JOIN cur c ON c.o_orderkey = s.o_orderkey""",
        "merge_change_counts": f"""
WITH {_CHANGES}
SELECT action, COUNT(*) AS n_rows FROM changes GROUP BY action""",
        "merge_inserts": f"""
WITH {_STATES}
SELECT o_orderkey, ver, o_totalprice FROM src s
WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.o_orderkey = s.o_orderkey)""",
        "merge_deletes": f"""
WITH {_STATES}
SELECT o_orderkey, ver FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = c.o_orderkey)""",
        "diff_by_version": f"""
WITH {_CHANGES}
SELECT o_orderkey, old_status, new_status, old_price, new_price FROM changes WHERE action = 'update'""",
        "diff_by_value": f"""
WITH {_CHANGES}
SELECT o_orderkey, old_status, new_status, old_price, new_price FROM changes
WHERE action IN ('update', 'same') AND value_changed""",
        "refresh_by_key": f"""
WITH {_STATES},
keys AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R')
SELECT o_orderkey, ver, o_orderstatus, o_totalprice FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM keys)
UNION ALL
SELECT o_orderkey, ver, o_orderstatus, o_totalprice FROM src WHERE o_orderkey IN (SELECT o_orderkey FROM keys)""",
        "lookup_join": f"""
WITH {_STATES},
keys AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem),
mirror AS (
  SELECT o_orderkey, ver, o_totalprice FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM keys)
  UNION ALL
  SELECT o_orderkey, ver, o_totalprice FROM src WHERE o_orderkey IN (SELECT o_orderkey FROM keys))
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, m.ver, m.o_totalprice
FROM lineitem l LEFT JOIN mirror m ON m.o_orderkey = l.l_orderkey""",
        "enum_merge": f"""
WITH {_MEMBERS}
SELECT ref, CAST(ord AS BIGINT) AS ord FROM existing WHERE ref IN (SELECT ref FROM members)
UNION ALL
SELECT ref, CAST((SELECT COALESCE(MAX(ord), 0) FROM existing) + row_number() OVER (ORDER BY pos, ref) AS BIGINT) AS ord
FROM members WHERE ref NOT IN (SELECT ref FROM existing)""",
        "enum_counts": f"""
WITH {_MEMBERS},
merged AS (
  SELECT ref, ord FROM existing WHERE ref IN (SELECT ref FROM members)
  UNION ALL
  SELECT ref, (SELECT COALESCE(MAX(ord), 0) FROM existing) + row_number() OVER (ORDER BY pos, ref) AS ord
  FROM members WHERE ref NOT IN (SELECT ref FROM existing)),
per AS (SELECT o_orderpriority AS ref, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT e.ref, CAST(e.ord AS BIGINT) AS ord, CAST(COALESCE(p.n, 0) AS BIGINT) AS n_orders
FROM merged e LEFT JOIN per p ON p.ref = e.ref""",
        "section_sales_topk": f"""
SELECT o.o_custkey AS customer, p.p_brand AS brand,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(38,10))), 2) AS DOUBLE) AS sales
FROM orders o
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_orderkey % 10 <> 1 AND p.p_type <> '{q.EXCLUDED_TYPE}'
GROUP BY o.o_custkey, p.p_brand
ORDER BY SUM(CAST(l.l_extendedprice AS DECIMAL(38,10))) DESC, customer, brand
LIMIT {q.TOPK}""",
        "page_set_check": f"""
WITH n AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderkey % 10 <> 1),
pages AS (
  SELECT UNNEST(range(0, CASE WHEN n < {q.DOCUMENT_FETCH_SIZE} THEN 1
                              ELSE (n - {q.DOCUMENT_FETCH_SIZE}) // {(q.DOCUMENT_FETCH_SIZE + 1) // 2} + 2 END)) AS page_no, n FROM n),
have AS (
  SELECT page_no, CASE WHEN page_no % 7 <> 3 THEN least({q.DOCUMENT_FETCH_SIZE}, n - page_no * {(q.DOCUMENT_FETCH_SIZE + 1) // 2}) END AS n_rows
  FROM pages WHERE page_no % 11 <> 5),
last AS (SELECT MAX(page_no) AS p FROM have),
expected AS (SELECT page_no + 1 AS page_no FROM have, last WHERE page_no < p UNION ALL SELECT 0)
SELECT page_no, n_rows,
  CASE WHEN n_rows IS NULL THEN 'corrupt' WHEN page_no = p AND n_rows >= {q.DOCUMENT_FETCH_SIZE} THEN 'no short page'
       WHEN page_no < p AND n_rows < {q.DOCUMENT_FETCH_SIZE} THEN 'short' ELSE 'ok' END AS state
FROM have, last
UNION ALL SELECT page_no, NULL, 'gap' FROM expected WHERE page_no NOT IN (SELECT page_no FROM have)""",
        "section_entity_refresh": f"""
SELECT l_orderkey AS o_orderkey,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS line_no,
  l_partkey, l_quantity + CASE WHEN l_orderkey % 10 = 2 THEN 1 ELSE 0 END AS quantity, l_extendedprice AS amount,
  CASE l_orderkey % 10 WHEN 0 THEN 'insert' WHEN 2 THEN 'update' ELSE 'same' END AS action
FROM lineitem
WHERE l_orderkey % 10 <> 1""",
        "materialized_view": f"""
SELECT o_orderkey,
  CAST(o_orderkey AS VARCHAR) || '-' || CASE WHEN o_orderkey % 10 = 2 THEN 'true' ELSE 'false' END AS ver
FROM orders
WHERE o_orderkey % 10 <> 1 AND upper(o_orderstatus) <> 'P'
ORDER BY o_orderkey LIMIT {q.VIEW_LIMIT}""",
        "check_columns": """
SELECT 'Покупатель' AS column_name, 'zero_guid' AS check_name,
       CAST(COUNT(*) FILTER (WHERE o_custkey % 10 = 0) AS BIGINT) AS n_violations FROM orders
UNION ALL SELECT 'Дата', 'zero_date', CAST(COUNT(*) FILTER (WHERE o_orderkey % 7 = 0) AS BIGINT) FROM orders
UNION ALL SELECT 'Статус', 'not_null', CAST(COUNT(*) FILTER (WHERE o_orderkey % 9 = 0) AS BIGINT) FROM orders
UNION ALL SELECT 'Приоритет', 'primitive_type', CAST(COUNT(*) FILTER (WHERE o_orderkey % 11 = 0) AS BIGINT) FROM orders
UNION ALL SELECT 'Данные', 'empty_binary', CAST(COUNT(*) FILTER (WHERE o_orderkey % 13 = 0) AS BIGINT) FROM orders""",
        "pk_violations": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "fk_violations": """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderkey % 10 <> 1)""",
        "refresh_stats": f"""
WITH counts AS ({_COUNTS})
SELECT table_name, CASE WHEN table_name = 'region' THEN 'Enumeration' ELSE 'Catalog' END AS kind,
  CAST({fetch} AS BIGINT) AS fetch_size, CAST(row_count AS BIGINT) AS row_count,
  CAST(CASE WHEN row_count < {fetch} THEN 1 ELSE (row_count - {fetch}) // {fstep} + 2 END AS BIGINT) AS n_pages
FROM counts""",
        "select_refresh": f"""
WITH counts AS ({_COUNTS})
SELECT table_name, CAST(row_count AS BIGINT) AS row_count FROM counts WHERE table_name <> 'region'""",
        "select_refresh_fast": f"""
WITH counts AS ({_COUNTS})
SELECT table_name, CAST(row_count AS BIGINT) AS row_count FROM counts
WHERE table_name <> 'region' AND row_count < {fetch}""",
    }
    sql["refresh_by_key_documents"] = sql["key_answers_in_batches"] = sql["refresh_by_key"]
    return {k: v.strip() for k, v in sql.items()}
