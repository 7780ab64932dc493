"""SQL that states the expected result of each registered query.

Offers are computed straight from the base columns, without any JSON.
"""

from __future__ import annotations

FACTS = """
facts AS (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS source_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS scraped_at_dt, c_mktsegment AS merchant, r_name AS category,
         (o_orderkey % 5) * 10 AS percent, (o_orderkey % 2) * 3 AS installments,
         o_orderstatus AS status, CAST(left(o_orderpriority, 1) AS BIGINT) AS priority,
         o_orderkey % 3 AS source_no
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _method(kind: str, network: str, tier: str) -> str:
    return f'{{"type":"{kind}","card_network":"{network}","card_tier":"{tier}"}}'


_COMMON = """
  merchant AS merchant_name, category AS merchant_category_name,
  DATE '1995-01-01' AS discount_start_date,
  CASE WHEN status = 'O' THEN DATE '2000-06-30' ELSE DATE '2001-12-31' END AS discount_end_date,
  CAST(percent * 100 AS DOUBLE) AS discount_max_discount_amount,
  CAST(installments * 5000 AS DOUBLE) AS discount_min_purchase_amount,
  CAST(installments AS BIGINT) AS discount_no_interest_installment_qty,
  CAST(priority - 1 AS VARCHAR) || ',' || CAST(priority AS VARCHAR) AS days,
  status = 'F' AS discount_valid_online, status IN ('F', 'O') AS discount_valid_instore,
  seq, source_id, scraped_at_dt"""

_OWN = {
    "bbva": f"""
  'Banco BBVA' AS issuer_name, CAST(percent AS DOUBLE) / 100 AS discount_rate,
  merchant || CASE WHEN percent = 40 THEN ' 40% de descuento' ELSE '' END AS discount_name,
  'Oferta' || CASE WHEN percent = 10 THEN ' 10% de descuento' ELSE '' END AS discount_description,
  'Bases.' || CASE WHEN installments > 0 THEN ' Compras superiores a $15.000' ELSE '' END
    || CASE WHEN percent = 20 THEN ' 20% de reintegro' ELSE '' END AS discount_terms_and_conditions,
  'https://www.bbva.com.ar/beneficios/beneficio.html?id=' || source_id AS discount_url,
  '{_method("credit_card", "all", "all")},{_method("debit_card", "all", "all")}' AS methods""",
    "galicia": f"""
  'Banco Galicia' AS issuer_name,
  CASE WHEN percent > 0 THEN CAST(percent AS DOUBLE) / 100 END AS discount_rate,
  CAST(NULL AS VARCHAR) AS discount_name, 'Promo' AS discount_description,
  'Legales' AS discount_terms_and_conditions,
  'https://galicia.ar/personas/buscador-de-promociones?path=/promocion/' || source_id || '|'
    || merchant || '|marca|' AS discount_url,
  '{_method("credit_card", "visa", "Standard")}' AS methods""",
    "naranjax": f"""
  'Naranja X' AS issuer_name, CAST(percent AS DOUBLE) / 100 AS discount_rate,
  CASE WHEN installments > 0 AND percent = 20 THEN 'Plan Z'
       WHEN installments > 0 THEN '3 cuotas cero interés' ELSE 'Descuento' END AS discount_name,
  'Promo' AS discount_description, 'Legal' AS discount_terms_and_conditions,
  'https://example.com/promo' AS discount_url,
  '{_method("credit_card", "naranja", "Standard")},{_method("debit_card", "naranja", "Standard")}' AS methods""",
}

STAGING_COLUMNS = """source_id, issuer_name, merchant_name, merchant_category_name,
  discount_start_date, discount_end_date, discount_rate, discount_name, discount_description,
  discount_terms_and_conditions, discount_url, discount_max_discount_amount,
  discount_min_purchase_amount, discount_no_interest_installment_qty, discount_valid_online,
  discount_valid_instore, days, methods, seq, scraped_at_dt"""


def staged_as(source: str) -> str:
    """Every order in the staging schema of one source."""
    return f"""WITH {FACTS}
SELECT {STAGING_COLUMNS} FROM (SELECT {_OWN[source]}, {_COMMON} FROM facts)"""


def _branch(source: str, number: int) -> str:
    return f"""SELECT {STAGING_COLUMNS} FROM
  (SELECT {_OWN[source]}, {_COMMON} FROM facts WHERE source_no = {number})"""


STAGED = (
    FACTS
    + ",\nstaged AS ("
    + "\nUNION ALL ".join(_branch(s, i) for i, s in enumerate(["bbva", "galicia", "naranjax"]))
    + ")"
)
KEPT = (
    STAGED
    + """,
kept AS (
  SELECT * EXCLUDE (scraped_at_dt), scraped_at_dt AS last_updated_at_date FROM staged
  WHERE (discount_rate <> 0 OR discount_no_interest_installment_qty <> 0)
    AND (discount_valid_instore OR discount_valid_online))"""
)
DEDUPED = (
    KEPT
    + """,
deduped AS (
  SELECT *, md5(source_id || '-' || issuer_name) AS discount_id FROM kept
  QUALIFY row_number() OVER (
    PARTITION BY source_id, issuer_name ORDER BY last_updated_at_date DESC, seq DESC) = 1)"""
)
AUDIT = (
    DEDUPED
    + """,
hashed AS (
  SELECT *, md5(concat_ws('-', issuer_name, merchant_name, merchant_category_name,
    CAST(discount_start_date AS VARCHAR), CAST(discount_end_date AS VARCHAR),
    coalesce(CAST(discount_rate AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    CAST(discount_max_discount_amount AS VARCHAR), CAST(discount_min_purchase_amount AS VARCHAR),
    CAST(discount_no_interest_installment_qty AS VARCHAR), days,
    CAST(discount_valid_online AS VARCHAR), CAST(discount_valid_instore AS VARCHAR), methods
  )) AS discount_content_hash FROM deduped),
audit AS (
  SELECT *, row_number() OVER (
    PARTITION BY discount_content_hash ORDER BY last_updated_at_date DESC, discount_id) AS rn
  FROM hashed)"""
)
NORMALISED = (
    AUDIT
    + """,
normalised AS (
  SELECT * EXCLUDE (merchant_name, merchant_category_name, rn),
    upper(left(merchant_name, 1)) || lower(substr(merchant_name, 2)) AS merchant_name,
    CASE WHEN merchant_name = 'FURNITURE' THEN 'Hogar y decoración'
         WHEN issuer_name = 'Banco BBVA' AND merchant_category_name = 'ASIA' THEN 'Viajes'
         WHEN issuer_name = 'Naranja X' AND merchant_category_name = 'EUROPE' THEN 'Otros'
         ELSE 'Sin categorizar' END AS merchant_category_clean
  FROM audit WHERE rn = 1)"""
)
FACT = (
    NORMALISED
    + """,
fact AS (
  SELECT discount_id AS id, issuer_name, merchant_name,
    merchant_category_clean AS merchant_category_name, discount_start_date AS start_date,
    discount_end_date AS end_date, discount_rate AS rate,
    discount_no_interest_installment_qty AS no_interest_installment_qty, discount_name AS name,
    discount_description AS description, discount_url AS url,
    discount_terms_and_conditions AS terms_and_conditions,
    discount_max_discount_amount AS max_discount_amount,
    discount_min_purchase_amount AS min_purchase_amount, days,
    discount_valid_online AS valid_online, discount_valid_instore AS valid_instore, methods,
    last_updated_at_date
  FROM normalised)"""
)
SERVING = (
    FACT
    + """,
serving AS (
  SELECT id AS discount_id, issuer_name, merchant_name, merchant_category_name,
    start_date AS discount_start_date, end_date AS discount_end_date,
    (start_date <= DATE '2000-12-31' AND end_date > DATE '2000-12-31') AS discount_is_active,
    rate AS discount_rate, no_interest_installment_qty AS discount_no_interest_installment_qty,
    name AS discount_name, description AS discount_description, url AS discount_url,
    terms_and_conditions AS discount_terms_and_conditions,
    max_discount_amount AS discount_max_discount_amount,
    min_purchase_amount AS discount_min_purchase_amount, days,
    valid_online AS discount_valid_online, valid_instore AS discount_valid_instore, methods,
    last_updated_at_date
  FROM fact)"""
)

_SUMMARY = """SELECT issuer_name, max(last_updated_at_date) AS last_scraped_at,
  count(*) AS discount_count FROM fact GROUP BY issuer_name"""

_FOUND = """merchant_name ~ '(?i).*(furn|mach).*'"""
_REFINED = f"""{_FOUND} AND merchant_category_name = 'Sin categorizar'
  AND issuer_name IN ('Banco BBVA', 'Naranja X')
  AND (days LIKE '%1%' OR days LIKE '%4%')"""

_DAY = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"
_DAY_SHORT = "['Lun','Mar','Mié','Jue','Vie','Sáb','Dom']"
_FORMATO = """CASE WHEN discount_valid_online AND discount_valid_instore THEN 'Online y Presencial'
    WHEN discount_valid_online THEN 'Solo Online'
    WHEN discount_valid_instore THEN 'Solo Presencial' ELSE 'Ver legales' END"""
_TYPES = """CASE WHEN issuer_name = 'Banco Galicia' THEN 'Tarjeta de crédito'
    ELSE 'Tarjeta de crédito,Tarjeta de débito' END"""

_UNPIVOT_CHECKS = """SELECT "check", "column", CAST(failing AS BIGINT) AS failing,
  CAST(total AS BIGINT) AS total, CAST(metric AS BIGINT) AS metric, status FROM"""


def _check(kind: str, column: str, failing: str, source: str, total: str = "count(*)", status=None,
           metric: str = "failing") -> str:
    status = status or "CASE WHEN metric > 0 THEN 'error' ELSE 'pass' END"
    return f"""{_UNPIVOT_CHECKS} (SELECT *, {status} AS status FROM (
  SELECT *, {metric} AS metric FROM (
  SELECT '{kind}' AS "check", '{column}' AS "column", {failing} AS failing, {total} AS total
  FROM {source})))"""


_BP = "CASE WHEN total = 0 THEN 0 ELSE round(10000 * failing / total) END"
_SHARE_STATUS = (
    "CASE WHEN metric > 500 THEN 'error' WHEN metric > 0 THEN 'warn' ELSE 'pass' END"
)


_REQUIRED = [
    "source_id",
    "issuer_name",
    "merchant_name",
    "merchant_category_name",
    "discount_start_date",
    "discount_end_date",
    "discount_rate",
    "discount_terms_and_conditions",
    "discount_url",
    "discount_max_discount_amount",
    "discount_min_purchase_amount",
    "discount_no_interest_installment_qty",
    "discount_valid_days_list",
    "discount_valid_online",
    "discount_valid_instore",
    "discount_payment_methods_list",
]


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Landing zone, tables and seeds
    sql["s1_read_landing"] = f"""WITH {FACTS}
SELECT CASE source_no WHEN 0 THEN 'bbva' WHEN 1 THEN 'galicia' ELSE 'naranjax' END AS spider,
  scraped_at_dt, source_id, seq FROM facts"""
    sql["s2_write_landing"] = f"""WITH {FACTS}
SELECT CASE source_no WHEN 0 THEN 'bbva' WHEN 1 THEN 'galicia' ELSE 'naranjax' END AS spider,
  scraped_at_dt, count(*) AS records,
  CAST(sum(seq) AS BIGINT) AS seq_total FROM facts GROUP BY ALL"""
    sql["s3_read_seed"] = """SELECT p_type, p_brand,
  CASE WHEN p_size > 25 THEN 'grande' ELSE 'chico' END AS kind, count(*) AS parts,
  CASE WHEN p_size > 25 THEN 'grande ' || lower(p_type) ELSE 'chico ' || lower(p_type) END AS category
FROM part GROUP BY ALL"""
    sql["s4_assemble_bbva"] = """SELECT CAST(o_orderkey AS VARCHAR) AS source_id,
  'de detalle ' || o_orderstatus AS subcabecera, o_orderpriority AS category_name,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '1995-01-01' END AS discount_start_date,
  strftime(o_orderdate, '%Y-%m-%d') AS discount_end_date,
  CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus <> 'P' AS has_start_value
FROM orders WHERE o_orderkey <> 0"""
    sql["s4_assemble_galicia"] = """SELECT CAST(o_orderkey AS VARCHAR) AS source_id,
  CAST(o_custkey AS VARCHAR) AS customer FROM orders WHERE o_orderkey <> 0"""
    sql["s4_assemble_naranjax"] = """SELECT 'c' || o_orderkey || '_' || plan AS id,
  CASE WHEN o_orderstatus = 'F' THEN 'https://x/' || o_orderkey
       ELSE 'https://x/' || o_orderkey || '/' || plan END AS discount_url,
  CAST(o_custkey AS VARCHAR) AS customer
FROM orders, (VALUES ('uno'), ('dos')) AS plans(plan)
WHERE (o_orderstatus <> 'F' OR plan = 'uno') AND NOT (o_orderpriority = '5-LOW' AND plan = 'dos')"""
    sql["s4_page_counts"] = """SELECT o_orderpriority AS priority,
  count(*) AS entries, CAST(ceil(count(*) / 7.0) AS BIGINT) AS pages,
  CAST(count(*) AS BIGINT) AS told FROM orders GROUP BY 1"""
    sql["s5_new_files"] = """SELECT CASE o_orderkey % 3 WHEN 0 THEN 'bbva' WHEN 1 THEN 'galicia'
  ELSE 'naranjax' END AS spider, CAST(2 AS BIGINT) AS new_files, CAST(0 AS BIGINT) AS later_files
FROM orders GROUP BY ALL"""
    sql["s5_file_ledger"] = """WITH months AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'bbva'
  WHEN 1 THEN 'galicia' ELSE 'naranjax' END AS spider, CAST(date_trunc('month', o_orderdate) AS DATE) AS scraped_at_dt FROM orders)
SELECT run, spider, scraped_at_dt, CAST(1 AS BIGINT) AS new_files FROM months, (VALUES (1), (2)) AS t(run)
WHERE run = 1 OR scraped_at_dt >= DATE '2000-01-01'"""
    sql["s6_write_table"] = f"WITH {SERVING} SELECT * FROM serving"
    sql["s7_load_discounts"] = f"WITH {SERVING} SELECT * FROM serving"
    sql["s7_load_issuers"] = f"WITH {FACT} {_SUMMARY}"

    # JSON access
    sql["j1_json_value"] = """SELECT event_id, json_extract_string(props, '$.k') AS k,
  CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS whole,
  event_type AS label, CAST(NULL AS VARCHAR) AS inner_object, '{user}' AS bracketed FROM events"""
    sql["j1_stored_payloads"] = f"""WITH {FACTS}
SELECT ['bbva', 'galicia', 'naranjax'][source_no + 1] AS spider, scraped_at_dt, seq FROM facts"""
    sql["j2_json_query"] = """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS subtree,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
    sql["j3_json_array"] = f"""WITH {FACTS}
SELECT seq, 2 AS methods, CASE WHEN status = 'O' THEN 1 ELSE 0 END AS commerces,
  CAST(NULL AS INTEGER) AS missing FROM facts"""
    sql["j4_json_value_array"] = f"""WITH {FACTS}
SELECT seq, CASE WHEN seq % 2 = 1 THEN 'debito,credito' ELSE 'credito,debito' END AS methods,
  CAST(priority AS VARCHAR) || ',' || CAST(priority + 1 AS VARCHAR) AS weekdays,
  TRUE AS mixed_is_null FROM facts"""
    sql["j5_json_text"] = """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS text,
  '{"type":"' || event_type || '","tier":null}' AS struct_text FROM events"""
    sql["j6_has_keys"] = """SELECT event_id, TRUE AS has_k, FALSE AS has_z, TRUE AS any_of,
  FALSE AS all_of, TRUE AS has_null, event_type <> 'error' AS has_inner FROM events"""
    sql["j7_array_index"] = f"""WITH {FACTS}
SELECT seq, CAST(percent * 100 AS VARCHAR) AS cap, CAST(installments AS VARCHAR) AS installments
FROM facts"""

    # Normalisation
    for source in ("bbva", "galicia", "naranjax"):
        number = {"bbva": 1, "galicia": 2, "naranjax": 3}[source]
        sql[f"p{number}_normalize_{source}"] = staged_as(source)
    sql["p4_rename"] = f"""WITH {KEPT} SELECT issuer_name, last_updated_at_date, seq FROM kept"""
    sql["p5_fact_columns"] = f"WITH {FACT} SELECT * FROM fact"
    sql["p6_serving_table"] = f"WITH {SERVING} SELECT * FROM serving"
    sql["u1_union_sources"] = f"WITH {STAGED} SELECT * FROM staged"

    # Filters
    sql["f1_worth_showing"] = f"WITH {KEPT} SELECT * FROM kept"
    sql["f2_required_keys"] = """SELECT o_orderkey, o_orderstatus <> 'F' AS kept_by_all,
  o_orderstatus <> 'F' OR o_orderkey % 2 = 0 AS kept_by_any FROM orders"""
    sql["f3_partition_filter"] = f"""WITH {FACTS}
SELECT scraped_at_dt, count(*) AS records
FROM facts WHERE source_no = 1 GROUP BY ALL"""
    sql["f4_newer_than"] = """SELECT o_orderkey, o_custkey,
  CAST(o_orderdate AS DATE) AS last_updated_at_date FROM orders WHERE o_orderdate > (
  SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate <= DATE '1999-06-30')"""
    sql["f5_up_to"] = """SELECT o_orderkey, o_custkey,
  CAST(o_orderdate AS DATE) AS last_updated_at_date FROM orders WHERE o_orderdate <= DATE '1999-06-30'"""

    # Joins
    sql["n1_resolve_category"] = f"""WITH {NORMALISED}
SELECT discount_id, merchant_name, merchant_category_clean FROM normalised"""
    sql["n1_lookup_chain"] = """SELECT c_custkey, CASE lower(c_mktsegment)
    WHEN 'building' THEN 'obra' WHEN 'machinery' THEN 'obra' ELSE
    CASE WHEN n_name IS NOT NULL THEN n_name || '/' || lower(c_mktsegment) ELSE 'otros' END
  END AS category FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3"""
    sql["n2_map_elements"] = """SELECT p_partkey,
  CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'color:rojo' WHEN 'blue' THEN 'color:azul'
    WHEN 'old' THEN 'edad:viejo' ELSE '?:?' END || ',' ||
  CASE split_part(p_name, ' ', 2) WHEN 'ring' THEN 'pieza:aro' WHEN 'gear' THEN 'pieza:rueda'
    ELSE '?:?' END AS words FROM part"""
    sql["n2_map_elements_join"] = """SELECT o_orderkey,
  a.c_mktsegment || ',' || coalesce(b.c_mktsegment, '?') AS segments FROM orders
  JOIN customer a ON o_custkey = a.c_custkey LEFT JOIN customer b ON o_custkey + 1 = b.c_custkey"""
    sql["n3_map_value"] = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'alta:1,maxima:1'
  WHEN '2-HIGH' THEN 'alta:2' ELSE '' END AS levels FROM orders"""
    sql["n3_map_value_join"] = """SELECT o_orderkey, c_mktsegment AS matches FROM orders
  JOIN customer ON o_custkey = c_custkey"""
    # Entries of one key stand in the order of their values, elements in array order.
    dims = """dims AS (SELECT 'large' AS dim, p_partkey % 500 AS k, p_brand, p_name FROM part
  UNION ALL SELECT 'small', p_partkey % 500, p_brand, p_name FROM part
  WHERE p_partkey % 500 < 30 AND p_brand < 'Brand#2'),
of_key AS (SELECT dim, k, string_agg(p_brand || ':' || p_name, ',' ORDER BY p_brand, p_name) AS entries
  FROM dims GROUP BY dim, k), sizes AS (SELECT unnest(['small', 'large']) AS dim)"""
    sql["n2_map_elements_sizes"] = f"""WITH {dims},
elements AS (SELECT o_orderkey, unnest([o_custkey % 40, o_custkey % 40 + 1, 7]) AS k,
  unnest([1, 2, 3]) AS place FROM orders)
SELECT o_orderkey, sizes.dim, string_agg(coalesce(entries, '?:?'), ',' ORDER BY place) AS entries
FROM elements CROSS JOIN sizes LEFT JOIN of_key ON of_key.k = elements.k AND of_key.dim = sizes.dim
GROUP BY o_orderkey, sizes.dim"""
    sql["n3_map_value_sizes"] = f"""WITH {dims}
SELECT o_orderkey, sizes.dim, coalesce(entries, '') AS entries
FROM orders CROSS JOIN sizes LEFT JOIN of_key ON of_key.k = o_custkey % 40 AND of_key.dim = sizes.dim"""
    sql["n6_explode_days"] = f"""WITH {STAGED}
SELECT issuer_name, CAST(day AS BIGINT) AS day, count(*) AS offers FROM (
  SELECT issuer_name, unnest(string_split(days, ',')) AS day FROM staged) GROUP BY ALL"""

    # Aggregations
    sql["a1_issuer_summary"] = """SELECT event_type AS issuer_name, max(CAST(ts AS DATE)) AS last_scraped_at,
  count(*) AS discount_count FROM events GROUP BY 1"""
    sql["a2_regroup_elements"] = """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS entries,
  CAST(len(string_split(p_name, ' ')) AS INTEGER) AS without_value FROM part"""
    sql["a3_basis_points"] = _check(
        "is_true_share", "cheap", "count(*) FILTER (WHERE NOT (l_discount < 0.1))", "lineitem",
        status=_SHARE_STATUS, metric=_BP)
    sql["a4_reconcile"] = """SELECT count(*) + 1 AS fact_count, CAST(count(*) AS BIGINT) AS summary_count
FROM events"""
    sql["a5_watermark"] = """SELECT CAST(max(o_orderdate) AS DATE) AS newest FROM orders"""
    sql["a6_totals"] = f"""WITH {SERVING}
SELECT (SELECT count(DISTINCT issuer_name) FROM serving) AS issuers,
  (SELECT count(*) FROM serving) AS discounts,
  (SELECT count(*) FROM serving WHERE discount_is_active) AS active_discounts"""
    sql["a7_items_per_category"] = f"""WITH {FACTS}
SELECT CASE source_no WHEN 0 THEN 'bbva' WHEN 1 THEN 'galicia' ELSE 'naranjax' END AS spider,
  category, count(*) AS items FROM facts GROUP BY ALL"""

    # Windows
    sql["w1_latest_by"] = """SELECT user_id, event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
    sql["w1_dedup_by_source"] = f"""WITH {DEDUPED} SELECT * FROM deduped"""
    sql["w2_rank_within"] = """SELECT event_id, event_type, row_number() OVER (
  PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events"""
    sql["w2_rank_by_samples"] = sql["w2_rank_within"]
    sql["w2_dedup_audit"] = f"""WITH {AUDIT}
SELECT discount_id, discount_content_hash, last_updated_at_date, rn FROM audit"""
    sql["w3_dedup_by_content"] = f"""WITH {AUDIT}
SELECT discount_id, discount_content_hash, last_updated_at_date FROM audit WHERE rn = 1"""

    # Keys, sort, page
    sql["k1_surrogate_key"] = """SELECT o_orderkey, md5(concat_ws('-', CAST(o_orderkey AS VARCHAR),
  CASE WHEN o_orderstatus = 'P' THEN '_dbt_utils_surrogate_key_null_' ELSE o_orderpriority END,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS key FROM orders"""
    sql["k2_list_text"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(least(l_linenumber, l_suppkey) AS VARCHAR) || ',' || CAST(greatest(l_linenumber, l_suppkey) AS VARCHAR)
    AS numbers,
  CASE WHEN l_returnflag <= l_linestatus
    THEN '{"code":"' || l_returnflag || '","note":null},{"code":"' || l_linestatus || '","note":null}'
    ELSE '{"code":"' || l_linestatus || '","note":null},{"code":"' || l_returnflag || '","note":null}'
  END AS structs FROM lineitem"""
    sql["k3_content_hash"] = f"""WITH {AUDIT} SELECT discount_id, discount_content_hash FROM hashed"""
    sql["l1_order"] = f"""WITH {SERVING} SELECT discount_id, discount_rate, merchant_name,
  row_number() OVER (ORDER BY discount_rate DESC NULLS LAST, merchant_name, discount_id) AS position FROM serving"""
    sql["l2_page"] = f"""WITH {SERVING} SELECT discount_id, discount_rate, merchant_name FROM serving
WHERE {_FOUND} AND issuer_name IN ('Banco BBVA', 'Banco Galicia', 'Naranja X') AND discount_is_active
ORDER BY discount_rate DESC NULLS LAST, merchant_name, discount_id LIMIT 20 OFFSET 20"""
    sql["l2_next_pages"] = f"""WITH {SERVING}, found AS (SELECT discount_id, discount_rate, merchant_name,
  row_number() OVER (ORDER BY discount_rate DESC NULLS LAST, merchant_name, discount_id) AS place,
  count(*) OVER () AS total FROM serving
WHERE {_FOUND} AND issuer_name IN ('Banco BBVA', 'Banco Galicia', 'Naranja X') AND discount_is_active)
SELECT CAST(ceil(place / 20.0) AS INTEGER) AS page, discount_id, discount_rate, merchant_name, total
FROM found WHERE place <= 60"""
    sql["l3_order_issuers"] = f"""WITH {FACT}, summary AS ({_SUMMARY})
SELECT *, row_number() OVER (ORDER BY issuer_name) AS position FROM summary"""

    # Merge
    newest = """SELECT o_custkey AS id, o_orderkey, o_orderstatus,
  CAST(o_orderdate AS DATE) AS last_updated_at_date FROM orders"""
    merged = f"""WITH rows AS ({newest}),
target AS (SELECT * FROM rows WHERE last_updated_at_date <= DATE '1999-06-30'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_updated_at_date DESC, o_orderkey DESC) = 1),
incoming AS (SELECT * FROM rows
  WHERE last_updated_at_date > (SELECT max(last_updated_at_date) FROM target)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_updated_at_date DESC, o_orderkey DESC) = 1)
SELECT * FROM target WHERE NOT EXISTS (SELECT 1 FROM incoming WHERE incoming.id = target.id)
UNION ALL SELECT * FROM incoming"""
    sql["m1_upsert"] = merged
    sql["m1_versions"] = merged
    sql["m1_upsert_buckets"] = merged

    # Checks
    sql["t1_not_null"] = f"""{_check("not_null", "l_shipdate", "count(*) FILTER (WHERE l_shipdate IS NULL)", "lineitem")}
UNION ALL {_check("not_null", "flag", "count(*) FILTER (WHERE l_returnflag = 'R')", "lineitem")}"""
    sql["t2_unique"] = f"""{_check("unique", "o_orderkey", "count(*) FILTER (WHERE n > 1)", "(SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)", "sum(n)")}
UNION ALL {_check("unique", "o_custkey", "count(*) FILTER (WHERE n > 1)", "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)", "sum(n)")}"""
    sql["t2_unique_increments"] = """WITH dated AS (SELECT o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) < 1997 THEN 0 WHEN year(o_orderdate) < 1999 THEN 1 ELSE 2 END AS increment FROM orders),
keys AS (SELECT increment, 'o_orderkey' AS "column", o_orderkey AS k FROM dated
  UNION ALL SELECT increment, 'o_custkey', o_custkey FROM dated),
counted AS (SELECT increment, "column", k, count(*) AS n FROM keys GROUP BY ALL),
met AS (SELECT *, row_number() OVER (PARTITION BY "column", k ORDER BY increment) > 1 AS before FROM counted),
reported AS (SELECT increment, "column", count(*) FILTER (WHERE n > 1 OR before) AS failing,
  CAST(sum(n) AS BIGINT) AS total FROM met GROUP BY ALL)
SELECT CAST(increment AS INTEGER) AS increment, 'unique' AS "check", "column", failing, total, failing AS metric,
  CASE WHEN failing > 0 THEN 'error' ELSE 'pass' END AS status FROM reported"""
    row_checks = {
        "not_null(flag)": "l_returnflag = 'R'",
        "between(l_discount)": "l_discount < 0.02 OR l_discount > 0.09",
        "is_true(gives)": "NOT (l_discount <> 0 OR l_tax <> 0)",
        "elements_between(numbers)": "l_linenumber - 2 NOT BETWEEN 0 AND 6 OR l_linenumber NOT BETWEEN 0 AND 6",
        "not_in(l_linestatus)": "l_linestatus IN ('F')",
        "not_empty(methods)": "l_returnflag = 'A' AND l_linenumber > 1",
    }
    listed = [
        f"""SELECT l_orderkey, l_linenumber, '{name.split("(")[0]}' AS "check",
  '{name.split("(")[1][:-1]}' AS "column" FROM lineitem WHERE {condition}"""
        for name, condition in row_checks.items()
    ]
    sql["t_quarantine"] = " UNION ALL ".join(listed)
    sql["t_failing_rows"] = sql["t_quarantine"] + """ UNION ALL SELECT l_orderkey, l_linenumber, 'unique', 'l_orderkey'
FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)"""
    elements = "CASE WHEN l_linenumber - 2 NOT BETWEEN 0 AND 6 THEN 1 ELSE 0 END + CASE WHEN l_linenumber NOT BETWEEN 0 AND 6 THEN 1 ELSE 0 END"
    sql["t_quarantine_report"] = " UNION ALL ".join(
        _check(
            name.split("(")[0],
            name.split("(")[1][:-1],
            f"sum({elements})" if "numbers" in name else f"count(*) FILTER (WHERE {condition})",
            "lineitem",
            "count(*) FILTER (WHERE l_linenumber > 1)" if "methods" in name else "count(*)",
        )
        for name, condition in row_checks.items()
    )
    sql["t3_between"] = f"""{_check("between", "l_discount", "count(*) FILTER (WHERE l_discount < 0.02 OR l_discount > 0.09)", "lineitem")}
UNION ALL {_check("between", "l_tax", "count(*) FILTER (WHERE l_tax < 0)", "lineitem")}"""
    sql["t4_is_true"] = _check("is_true", "gives", "count(*) FILTER (WHERE NOT (l_discount <> 0 OR l_tax <> 0))", "lineitem")
    sql["t5_is_true_share"] = f"""{_check("is_true_share", "gives", "count(*) FILTER (WHERE NOT (l_discount <> 0 OR l_tax <> 0))", "lineitem", status=_SHARE_STATUS, metric=_BP)}
UNION ALL {_check("is_true_share", "known", "count(*) FILTER (WHERE l_returnflag = 'R')", "lineitem", status=_SHARE_STATUS, metric=_BP)}"""
    sql["t6_elements_between"] = _check("elements_between", "sizes",
        "sum(CASE WHEN l_linenumber - 2 NOT BETWEEN 0 AND 6 THEN 1 ELSE 0 END + CASE WHEN l_linenumber NOT BETWEEN 0 AND 6 THEN 1 ELSE 0 END)", "lineitem")
    sql["t7_not_empty"] = _check("not_empty", "methods", "count(*) FILTER (WHERE l_returnflag = 'A')", "lineitem")
    sql["t8_not_in"] = _check("not_in", "o_orderpriority", "count(*) FILTER (WHERE o_orderpriority IN ('5-LOW', '1-URGENT'))", "orders")
    sql["t9_required_keys"] = _check("has_required_keys", "payload", "count(*) FILTER (WHERE o_orderstatus = 'F')",
        "orders WHERE o_orderpriority <> '5-LOW'", status="CASE WHEN metric > 9 THEN 'error' WHEN metric > 0 THEN 'warn' ELSE 'pass' END")
    def nulls(kind: str, rest: str) -> str:
        status = "CASE WHEN metric > 9 THEN 'error' WHEN metric > 0 THEN 'warn' ELSE 'pass' END"
        return _check(kind, "raw_payload", f"count(*) FILTER (WHERE o_orderkey % 10 {rest})", "orders", status=status)

    sql["t9_null_payloads"] = f"""{nulls('has_required_keys', '= 0')} UNION ALL {nulls('has_payload', '< 2')}"""
    sql["t10_reconcile"] = f"WITH {FACT} SELECT 0 AS fact_count, 0 AS summary_count FROM fact WHERE FALSE"
    sql["t11_severity"] = """SELECT l_linenumber AS line, count(*) FILTER (WHERE l_tax = 0) AS metric,
  CASE WHEN count(*) FILTER (WHERE l_tax = 0) > 900 THEN 'error'
       WHEN count(*) FILTER (WHERE l_tax = 0) > 500 THEN 'warn' ELSE 'pass' END AS status
FROM lineitem GROUP BY 1"""

    checked = [
        ("is_true_share", "usable", "count(*) FILTER (WHERE status = 'P')"),
        ("is_true_share", "gives", "0"),
        *[("not_null", c, "0") for c in _REQUIRED if c != "discount_rate"],
        ("not_null", "discount_rate", "count(*) FILTER (WHERE percent = 0)"),
        ("between", "discount_rate", "0"),
        ("between", "discount_max_discount_amount", "0"),
        ("between", "discount_min_purchase_amount", "0"),
        ("between", "discount_no_interest_installment_qty", "0"),
        ("elements_between", "discount_valid_days_list", "0"),
        ("not_empty", "discount_payment_methods_list", "0"),
    ]
    parts = []
    for kind, column, failing in checked:
        share = kind == "is_true_share"
        limits = {"status": _SHARE_STATUS, "metric": _BP} if share else {}
        parts.append(_check(kind, column, failing, "facts", **limits))
    sql["t_staging_checks"] = f"WITH {FACTS}\n" + "\nUNION ALL ".join(parts)

    # Search
    sql["q1_text"] = f"WITH {SERVING} SELECT discount_id, merchant_name FROM serving WHERE {_FOUND}"
    sql["q1_text_indexed"] = sql["q1_text"]
    sql["q1_text_literal"] = """SELECT p_partkey, p_name, contains(lower(p_name), 'red w') AS literal,
  regexp_matches(p_name, '(?i)^(red|old) .*e') AS pattern FROM part"""
    sql["q2_category"] = f"""WITH {SERVING} SELECT discount_id FROM serving
WHERE merchant_category_name = 'Hogar y decoración'"""
    sql["q3_no_choice"] = f"WITH {SERVING} SELECT discount_id FROM serving WHERE FALSE"
    sql["q4_issuers_merchants"] = f"""WITH {SERVING} SELECT discount_id FROM serving
WHERE {_FOUND} AND issuer_name IN ('Banco BBVA', 'Naranja X') AND merchant_name IN ('Machinery')"""
    sql["q5_days"] = f"""WITH {SERVING} SELECT discount_id, days FROM serving WHERE {_REFINED}"""
    sql["q6_formato"] = f"""WITH {SERVING} SELECT discount_id, {_FORMATO} AS formato FROM serving
WHERE {_REFINED} AND {_FORMATO} = 'Online y Presencial'"""
    sql["q7_payment_types"] = f"""WITH {SERVING} SELECT discount_id, {_TYPES} AS types FROM serving
WHERE {_FOUND} AND {_TYPES} LIKE '%débito%'"""
    sql["q8_active"] = f"""WITH {SERVING} SELECT discount_id FROM serving WHERE {_FOUND} AND discount_is_active"""
    sql["q9_facets"] = f"""WITH {SERVING}, narrow AS (SELECT * FROM serving WHERE {_REFINED})
SELECT DISTINCT 'category' AS facet, merchant_category_name AS value FROM serving
UNION ALL SELECT DISTINCT 'issuer', issuer_name FROM serving
  WHERE {_FOUND} AND merchant_category_name = 'Sin categorizar'
UNION ALL SELECT DISTINCT 'merchant', merchant_name FROM narrow
UNION ALL SELECT DISTINCT 'formato', {_FORMATO} FROM narrow
UNION ALL SELECT DISTINCT 'payment_type', unnest(string_split({_TYPES}, ',')) FROM narrow"""
    sql["q9_facets_one_pass"] = f"""WITH {SERVING}, narrow AS (SELECT * FROM serving WHERE {_REFINED})
SELECT DISTINCT 'merchant' AS facet, merchant_name AS value FROM narrow
UNION ALL SELECT DISTINCT 'formato', {_FORMATO} FROM narrow
UNION ALL SELECT DISTINCT 'payment_type', unnest(string_split({_TYPES}, ',')) FROM narrow"""
    sql["q9_facets_one_scan"] = sql["q9_facets"]
    sql["q10_found_count"] = f"""WITH {SERVING}
SELECT 'active' AS counted, count(*) FILTER (WHERE discount_is_active) AS discounts FROM serving WHERE {_FOUND}
UNION ALL SELECT 'all', count(*) FROM serving WHERE {_FOUND}"""

    # Labels
    percent = """CASE WHEN l_discount > 0 THEN CAST(CAST(round_even(l_discount / 2 * 100, 0) AS BIGINT) AS VARCHAR) || '%'
  ELSE '-' END"""
    sql["d1_days"] = f"""SELECT o_orderkey,
  CASE p WHEN 1 THEN 'Todos' WHEN 2 THEN '-'
    ELSE {_DAY}[least(p, q) + 1] || CASE WHEN p <> q THEN ', ' || {_DAY}[greatest(p, q) + 1] ELSE '' END END AS text,
  CASE p WHEN 1 THEN 'Lun,Mar,Mié,Jue,Vie,Sáb,Dom' WHEN 2 THEN ''
    ELSE {_DAY_SHORT}[p + 1] || ',' || {_DAY_SHORT}[q + 1] END AS names
FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS p,
  CAST(o_orderkey % 7 AS INTEGER) AS q FROM orders)"""
    sql["d2_percent"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {percent} AS text FROM lineitem"""
    sql["d3_amounts"] = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5 AS VARCHAR) ELSE '-' END AS installments,
  CASE WHEN o_orderstatus = 'P' THEN 'N/A' WHEN o_orderstatus = 'F' THEN 'Sin mínimo'
    ELSE '$' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS minimum,
  CASE WHEN o_orderstatus = 'P' THEN 'N/A' WHEN o_orderstatus = 'F' THEN 'Sin tope'
    ELSE '$' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS cap FROM orders"""
    sql["d4_payment_text"] = f"""WITH {AUDIT} SELECT discount_id, CASE issuer_name
  WHEN 'Banco BBVA' THEN 'Tarjeta de crédito Todas, Tarjeta de débito Todas'
  WHEN 'Banco Galicia' THEN 'Tarjeta de crédito visa Standard'
  ELSE CASE WHEN seq % 2 = 1 THEN 'Tarjeta de débito naranja Standard, Tarjeta de crédito naranja Standard'
    ELSE 'Tarjeta de crédito naranja Standard, Tarjeta de débito naranja Standard' END END AS text
FROM audit WHERE rn = 1"""
    sql["d5_payment_groups"] = f"""WITH {AUDIT} SELECT discount_id, CASE issuer_name
  WHEN 'Banco BBVA' THEN 'Tarjeta de crédito (Todas), Tarjeta de débito (Todas)'
  WHEN 'Banco Galicia' THEN 'Tarjeta de crédito (visa Standard)'
  ELSE CASE WHEN seq % 2 = 1 THEN 'Tarjeta de débito (naranja Standard), Tarjeta de crédito (naranja Standard)'
    ELSE 'Tarjeta de crédito (naranja Standard), Tarjeta de débito (naranja Standard)' END END AS text
FROM audit WHERE rn = 1"""
    sql["d6_truncate"] = r"""SELECT doc_id, CASE WHEN length(t) > 150 THEN left(t, 150) || '...' ELSE t END AS text
FROM (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents)"""
    sql["d7_day_text"] = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N/A'
  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS text FROM orders"""
    # What stands before the text, by doc_id: nothing, a ligature, a fraction, a digraph,
    # letters and a digit beyond the basic plane, a numeral, a dotted I, a sharp s.
    sql["d8_plain_key"] = """SELECT doc_id, ['', 'finca', '12precio', 'dz', 'anco1', 'viii', 'i', ''][doc_id % 8 + 1] ||
  regexp_replace(strip_accents(lower(text)), '[^a-z0-9]', '', 'g') AS key FROM documents"""
    sql["d9_issuer_status"] = """SELECT event_type AS issuer_name, CAST(date_trunc('day', max(ts)) AS TIMESTAMP) AS last_scraped_at,
  count(*) AS discount_count, lower(event_type) AS issuer_key,
  strftime(max(ts), '%d/%m/%Y') || ' 00:00' AS last_scraped_label,
  CASE event_type WHEN 'click' THEN 'nuevo.png' WHEN 'view' THEN 'view.png' END AS icon_file
FROM events GROUP BY event_type"""
    sql["d_initcap"] = r"""SELECT doc_id, array_to_string(list_transform(
  regexp_extract_all(text, '[\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-]+|[^\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-]+'),
  lambda w: CASE left(w, 1) WHEN 'ß' THEN 'Ss' ELSE upper(left(w, 1)) END || lower(substr(w, 2))), '') AS title FROM documents"""

    sql["d_display_columns"] = f"""WITH {SERVING} SELECT discount_id,
  {_DAY_SHORT}[a + 1] || ',' || {_DAY_SHORT}[b + 1] AS names,
  {_DAY}[a + 1] || ', ' || {_DAY}[b + 1] AS valid_days_text, {_FORMATO} AS formato,
  CASE WHEN discount_rate > 0 THEN CAST(CAST(discount_rate * 100 AS BIGINT) AS VARCHAR) || '%'
    ELSE '-' END AS rate_text,
  CASE WHEN discount_no_interest_installment_qty > 0 THEN '3 cuotas' ELSE '-' END AS installments_text,
  CASE WHEN discount_min_purchase_amount > 0 THEN '$15000' ELSE 'Sin mínimo' END AS minimum_text,
  CASE WHEN discount_max_discount_amount > 0
    THEN '$' || CAST(CAST(discount_max_discount_amount AS BIGINT) AS VARCHAR) ELSE 'Sin tope' END AS cap_text,
  {_TYPES} AS types, strftime(discount_start_date, '%d/%m/%Y') AS start_text,
  strftime(discount_end_date, '%d/%m/%Y') AS end_text
FROM (SELECT *, CAST(split_part(days, ',', 1) AS INTEGER) AS a,
  CAST(split_part(days, ',', 2) AS INTEGER) AS b FROM serving)"""

    # Metrics
    sql["r1_run_stats"] = """SELECT event_id, event_type AS spider, CAST(user_id AS DOUBLE) AS items_scraped,
  value AS elapsed_seconds, CASE WHEN event_id % 2 = 0 THEN value * 2 END AS responses_per_minute,
  CAST(event_id AS DOUBLE) AS items_per_minute,
  CASE WHEN event_type = 'error' THEN CAST(event_id % 10 AS DOUBLE) END AS responses_403 FROM events"""
    sql["r2_histogram"] = """SELECT event_type AS spider, CASE WHEN value < 1 THEN 0
    ELSE CAST(len(list_filter(range(0, 65), lambda i: pow(2.0, i) <= value)) AS INTEGER) END AS bucket, count(*) AS n
FROM events GROUP BY ALL"""
    sql["r2_histogram_stream"] = sql["r2_histogram"]
    stats = sql["r1_run_stats"]
    sql["r2_run_histogram"] = f"""SELECT spider, metric, CASE WHEN value < 1 THEN 0
    ELSE CAST(len(list_filter(range(0, 65), lambda i: pow(2.0, i) <= value)) AS INTEGER) END AS bucket,
  count(*) AS n
FROM (UNPIVOT ({stats}) ON items_scraped, elapsed_seconds, responses_per_minute, items_per_minute,
  responses_403 INTO NAME metric VALUE value) GROUP BY ALL"""
    sql["r3_failure_alerts"] = """SELECT time_bucket(INTERVAL '60 seconds', ts) AS window_start,
  time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end,
  CAST(user_id AS VARCHAR) AS workflow_id, count(*) AS failures FROM events
WHERE event_type = 'error' GROUP BY ALL"""
    sql["r3_failure_alerts_stream"] = sql["r3_failure_alerts"]
    sql["r4_run_summary"] = """SELECT 'build-1' AS build_id, event_type AS spider,
  CAST(max(event_id) AS VARCHAR) AS execution,
  count(*) FILTER (WHERE value >= 100) AS new_files FROM events GROUP BY event_type"""
    sql["r5_landing_stream"] = f"""WITH {KEPT}
SELECT source_id, issuer_name, last_updated_at_date, seq, discount_rate, days, methods FROM kept
QUALIFY row_number() OVER (
  PARTITION BY source_id, issuer_name ORDER BY last_updated_at_date DESC, seq DESC) = 1"""
    sql["r5_stream_fact"] = f"WITH {FACT} SELECT * FROM fact"
    sql["r5_fact_upserts"] = sql["r5_stream_fact"]
    sql["b_build_fact"] = f"WITH {FACT} SELECT * FROM fact"
    # Both dedups prefer the newest day, so loading in two steps gives the same rows.
    sql["b_incremental_build"] = f"WITH {FACT} SELECT * FROM fact"
    return sql
