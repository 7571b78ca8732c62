"""ERP-shaped views over the test tables.

Each text is valid in Spark SQL and in DuckDB, so the queries and their SQL checks read the same
input. Every view covers all rows of the tables it reads; where only part of the documents have a
property, an attribute of the row decides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.sizes import TableSize, row_bytes, table_size
from ledgerloom.sources.tables import Tables

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "conversations", "pages")

LINE_ID = ("concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
           "CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))")
ORDER_NAME = "concat('P', lpad(CAST(o_orderkey AS STRING), 9, '0'))"
CURRENCY = ("CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 2 "
            "WHEN o_orderstatus = 'O' THEN 163 ELSE 1 END")
QTY = "CAST(l_quantity AS DECIMAL(18,4))"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
UNIT_PRICE = "CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(18,2))"
WITH_TAX = f"CAST({PRICE} * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4))"

VIEWS: dict[str, str] = {
    "res_partner": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('+000 ', CAST(c_custkey AS STRING)) END AS phone,
               concat('p', CAST(c_custkey AS STRING), '@example.com') AS email,
               concat('NIT', CAST(c_custkey AS STRING)) AS vat
        FROM customer""",
    "res_users": """
        SELECT s_suppkey AS id, s_suppkey AS partner_id, lower(s_name) AS login FROM supplier""",
    "res_currency": """
        SELECT * FROM (VALUES (163, 'GTQ'), (2, 'USD'), (1, 'EUR')) AS t(id, name)""",
    "res_company": """
        SELECT * FROM (VALUES (0, 'Company A'), (1, 'Company B')) AS t(id, name)""",
    "purchase_order": f"""
        SELECT o_orderkey AS id, {ORDER_NAME} AS name,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('REF-', CAST(o_custkey AS STRING)) END AS partner_ref,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'purchase' WHEN '2-HIGH' THEN 'sent'
                    WHEN '3-MEDIUM' THEN 'draft' WHEN '4-NOT SPECIFIED' THEN 'to approve'
                    ELSE CASE WHEN o_orderstatus = 'F' THEN 'cancel' ELSE 'done' END END AS state,
               CAST(o_orderdate AS DATE) AS date_order,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT) END AS date_planned,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount_total,
               CAST(floor(o_totalprice * 100 / 1.12) / 100 AS DECIMAL(18,2)) AS amount_untaxed,
               CAST(CAST(o_totalprice AS DECIMAL(18,2))
                    - CAST(floor(o_totalprice * 100 / 1.12) / 100 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS amount_tax,
               {CURRENCY} AS currency_id, o_custkey AS partner_id,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 10 END AS user_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'no' WHEN 1 THEN 'to invoice' ELSE 'invoiced' END AS invoice_status,
               CASE WHEN o_orderkey % 2 = 0 THEN 'full' ELSE 'pending' END AS receipt_status,
               CASE WHEN o_orderkey % 5 = 0 THEN '<p>urgent&nbsp;order<br/>call &amp; confirm</p>'
                    WHEN o_orderkey % 5 = 1 THEN NULL ELSE '' END AS internal_notes
        FROM orders""",
    "purchase_order_line": f"""
        SELECT {LINE_ID} AS id, l_orderkey AS order_id, l_partkey AS product_id,
               concat('line ', CAST(l_linenumber AS STRING), '  of  ', CAST(l_orderkey AS STRING)) AS name,
               {QTY} AS product_qty,
               CASE l_returnflag WHEN 'N' THEN CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(0 AS DECIMAL(18,4)) END
                    WHEN 'R' THEN CAST(floor(l_quantity / 2) AS DECIMAL(18,4)) ELSE {QTY} END AS qty_received,
               CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(0 AS DECIMAL(18,4)) END
                    WHEN l_discount < 0.05 THEN {QTY} ELSE CAST(floor(l_quantity / 2) AS DECIMAL(18,4)) END AS qty_invoiced,
               {UNIT_PRICE} AS price_unit, {WITH_TAX} AS price_total, CAST(l_shipdate AS DATE) AS date_planned
        FROM lineitem""",
    "account_move": f"""
        SELECT o_orderkey AS id, concat('BILL/', CAST(o_orderkey AS STRING)) AS name,
               concat('ref ', CAST(o_custkey AS STRING)) AS ref,
               CASE WHEN o_orderkey % 11 = 0 THEN 'in_refund' ELSE 'in_invoice' END AS move_type,
               CASE WHEN o_orderkey % 13 = 0 THEN 'cancel' WHEN o_orderkey % 7 = 0 THEN 'draft' ELSE 'posted' END AS state,
               CASE o_orderkey % 4 WHEN 0 THEN 'paid' WHEN 1 THEN 'partial' ELSE 'not_paid' END AS payment_state,
               CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE {ORDER_NAME} END AS invoice_origin,
               CAST(o_orderdate AS DATE) AS invoice_date,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS invoice_date_due,
               CAST(o_orderdate AS DATE) AS date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount_total_signed,
               CASE o_orderkey % 4 WHEN 0 THEN CAST(0 AS DECIMAL(18,2))
                    WHEN 1 THEN CAST(floor(o_totalprice * 50) / 100 AS DECIMAL(18,2))
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount_residual_signed,
               {CURRENCY} AS currency_id, o_custkey AS partner_id,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '<p>terms</p><p>net  30</p>' END AS narration
        FROM orders""",
    "account_move_line": f"""
        SELECT concat('A', {LINE_ID}) AS id, l_orderkey AS move_id,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE {LINE_ID} END AS purchase_line_id,
               l_partkey AS product_id, concat('item ', CAST(l_linenumber AS STRING)) AS name,
               CASE WHEN l_linenumber = 1 THEN 'line_section' ELSE NULL END AS display_type,
               {QTY} AS quantity, {UNIT_PRICE} AS price_unit, {PRICE} AS price_subtotal, {WITH_TAX} AS price_total,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS ref, l_linenumber AS sequence
        FROM lineitem""",
    "account_move_purchase_order_rel": """
        SELECT o_orderkey AS account_move_id,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey - 1 END AS purchase_order_id
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "account_analytic_account": """
        SELECT c_custkey AS id, concat('Account ', c_name) AS name FROM customer""",
    "sale_order": """
        SELECT o_orderkey AS id, concat('S', CAST(o_orderkey AS STRING)) AS name, CAST(o_orderdate AS DATE) AS date_order,
               CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'sale' END AS state, o_custkey AS partner_id,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS analytic_account_id
        FROM orders""",
    "sale_order_line": """
        SELECT o_orderkey AS id, o_orderkey AS order_id, concat('sale line ', CAST(o_orderkey AS STRING)) AS name
        FROM orders""",
    "product_product": """
        SELECT p_partkey AS id, p_partkey AS product_tmpl_id, concat('SKU', CAST(p_partkey AS STRING)) AS default_code,
               CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('77', CAST(p_partkey AS STRING)) END AS barcode,
               p_partkey % 23 <> 0 AS active
        FROM part""",
    "product_template": """
        SELECT p_partkey AS id,
               CASE p_partkey % 3 WHEN 0 THEN concat('{"es_GT":"', p_name, '","en_US":"x"}')
                    WHEN 1 THEN concat('{"en_US":"', p_name, '"}') ELSE p_name END AS name,
               CASE WHEN p_partkey % 10 = 9 THEN 'service' ELSE 'product' END AS type,
               p_size AS categ_id, CAST(p_partkey % 4 AS INT) AS uom_id, p_partkey % 29 <> 0 AS active
        FROM part""",
    "product_category": """
        SELECT DISTINCT p_size AS id, concat('Category ', CAST(p_size AS STRING)) AS name,
               concat('All / Category ', CAST(p_size AS STRING)) AS complete_name
        FROM part WHERE p_size <> 13""",
    "uom_uom": """
        SELECT * FROM (VALUES (0, '{"es_GT":"Unidad","en_US":"Unit"}'), (1, '{"en_US":"kg"}'), (2, 'm')) AS t(id, name)""",
    "ir_property": """
        SELECT concat('product.product,', CAST(p_partkey AS STRING)) AS res_id, 'standard_price' AS name,
               CAST(p_retailprice AS DECIMAL(18,4)) AS value_float
        FROM part WHERE p_size <> 21
        UNION ALL
        SELECT concat('product.product,', CAST(p_partkey AS STRING)), 'weight', CAST(p_size AS DECIMAL(18,4)) FROM part""",
    "stock_location": """
        SELECT n_nationkey AS id, n_name AS name, concat('WH / ', n_name) AS complete_name,
               CASE n_nationkey % 6 WHEN 0 THEN 'supplier' WHEN 1 THEN 'customer' WHEN 3 THEN 'production'
                    WHEN 4 THEN 'inventory' ELSE 'internal' END AS usage,
               CASE WHEN n_nationkey % 7 = 5 THEN NULL ELSE n_regionkey END AS warehouse_id
        FROM nation""",
    "stock_warehouse": """
        SELECT r_regionkey AS id, r_name AS name, r_regionkey % 2 AS company_id FROM region""",
    "stock_quant": """
        SELECT l_partkey AS product_id, CAST(l_suppkey % 25 AS INT) AS location_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(18,4)) AS quantity
        FROM lineitem""",
    "stock_move": f"""
        SELECT {LINE_ID} AS id, concat('MOVE/', CAST(l_orderkey AS STRING)) AS name, l_shipdate AS date,
               l_shipdate - INTERVAL 1 DAY AS create_date, l_partkey AS product_id,
               CAST(l_partkey % 4 AS INT) AS product_uom,
               CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(18,4)) ELSE {QTY} END AS product_uom_qty,
               CASE WHEN l_discount > 0.05 THEN {QTY} ELSE CAST(0 AS DECIMAL(18,4)) END AS quantity_done,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE {UNIT_PRICE} END AS price_unit,
               CASE WHEN l_returnflag = 'R' THEN 8 ELSE CAST(l_suppkey % 25 AS INT) END AS location_id,
               CASE WHEN l_returnflag = 'A' THEN 8 ELSE CAST(l_partkey % 25 AS INT) END AS location_dest_id,
               CASE WHEN l_linestatus = 'F' THEN 'done' WHEN l_tax > 0.06 THEN 'cancel' ELSE 'assigned' END AS state,
               'make_to_stock' AS procure_method,
               CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_suppkey % 50 AS INT) END AS usage_purpose_id,
               CASE WHEN l_linenumber = 4 THEN NULL ELSE concat('O', CAST(l_orderkey AS STRING)) END AS origin,
               concat('WH/', CAST(l_orderkey AS STRING)) AS reference, l_orderkey AS picking_id,
               l_suppkey AS create_uid, CASE WHEN l_linenumber = 4 THEN NULL ELSE l_suppkey + 1 END AS write_uid,
               CASE WHEN l_linenumber % 3 = 0 THEN {LINE_ID} ELSE NULL END AS purchase_line_id,
               CASE WHEN l_linenumber % 3 = 1 THEN l_orderkey ELSE NULL END AS sale_line_id,
               CASE WHEN l_linenumber % 4 = 0 THEN l_orderkey ELSE NULL END AS production_id,
               CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey ELSE NULL END AS raw_material_production_id
        FROM lineitem""",
    "stock_move_line": f"""
        SELECT concat('a', {LINE_ID}) AS id, {LINE_ID} AS move_id, l_suppkey AS lot_id FROM lineitem WHERE l_returnflag <> 'N'
        UNION ALL
        SELECT concat('b', {LINE_ID}), {LINE_ID}, l_suppkey + 7 FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1""",
    "stock_picking": f"""
        SELECT o_orderkey AS id, concat('WH/IN/', CAST(o_orderkey AS STRING)) AS name, {ORDER_NAME} AS origin,
               CASE WHEN o_orderstatus = 'O' THEN 'handle with care' ELSE NULL END AS note, o_custkey AS partner_id
        FROM orders""",
    "mrp_production": """
        SELECT o_orderkey AS id, concat('MO/', CAST(o_orderkey AS STRING)) AS name,
               CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'confirmed'
                    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'cancel' ELSE 'progress' END END AS state,
               o_custkey AS product_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE NULL END AS analytic_account_id,
               o_orderdate AS date_planned_start, o_orderdate + INTERVAL 5 DAY AS date_planned_finished
        FROM orders""",
    "project_project": """
        SELECT n_nationkey AS id, CASE WHEN n_nationkey = 3 THEN NULL ELSE concat('{"es_GT":"', n_name, '"}') END AS name,
               concat('<p>Site &amp; plan of ', n_name, '</p>') AS description, DATE '1995-01-01' AS date_start,
               CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE DATE '2001-12-31' END AS date, n_nationkey % 12 <> 11 AS active
        FROM nation""",
    "project_task_type": """
        SELECT * FROM (VALUES (1, '{"es_GT":"En Progreso"}'), (2, '{"es_GT":"Hecho"}'), (3, '{"es_GT":"Bloqueado"}'))
        AS t(id, name)""",
    "project_task": """
        SELECT -1 - c_custkey AS id, c_name AS name, concat('<div>Work for ', c_name, '<br/>step one</div>') AS description,
               CAST(NULL AS BIGINT) AS parent_id, c_nationkey AS project_id,
               CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE NULL END AS stage_id, 10 AS sequence,
               CAST(NULL AS DATE) AS fecha_inicio,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE DATE '1998-01-01' + CAST(c_custkey % 400 AS INT) END AS date_deadline,
               CAST(NULL AS TIMESTAMP) AS date_end, c_custkey % 3 = 1 AS is_closed,
               CAST(c_custkey % 101 AS DECIMAL(18,4)) AS progress, CAST(8 AS DECIMAL(18,4)) AS planned_hours,
               CAST(4 AS DECIMAL(18,4)) AS effective_hours, CAST(4 AS DECIMAL(18,4)) AS remaining_hours,
               c_custkey % 20 <> 19 AS active, c_custkey AS analytic_account_id
        FROM customer
        UNION ALL
        SELECT o_orderkey, concat('T', CAST(o_orderkey AS STRING)), NULL, -1 - o_custkey, c_nationkey,
               CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END, CAST(o_orderkey % 5 AS INT),
               CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) END,
               o_orderdate, CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_orderstatus = 'F' END,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DECIMAL(18,4)) END,
               CAST(2 AS DECIMAL(18,4)), CAST(1.5 AS DECIMAL(18,4)), CAST(0.5 AS DECIMAL(18,4)), o_orderkey % 20 <> 19,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN o_custkey ELSE NULL END
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "project_task_user_rel": """
        SELECT o_orderkey AS task_id, o_custkey % 10 AS user_id FROM orders
        UNION ALL
        SELECT o_orderkey, (o_custkey + 3) % 10 FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "project_task_purchase_order_rel": """
        SELECT CASE WHEN o_orderkey % 4 = 0 THEN -1 - o_custkey ELSE o_orderkey END AS task_id, o_orderkey AS purchase_order_id
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT -1 - o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "task_dependencies_rel": """
        SELECT o_orderkey AS task_id, prev AS depends_on_id
        FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
              FROM orders) t WHERE prev IS NOT NULL
        UNION ALL
        SELECT o_orderkey, -1 - o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "hr_department": """
        SELECT * FROM (VALUES (0, 'Obra'), (1, 'Seguridad Industrial'), (2, 'Operativo'), (3, 'Bodega'),
                              (4, 'Administración'), (5, 'Mantenimiento'), (6, 'Ventas'), (7, 'Legal')) AS t(id, name)""",
    "hr_employee": """
        SELECT user_id AS id, concat('Worker ', lpad(CAST(user_id AS STRING), 9, '0')) AS name,
               CASE WHEN user_id % 3 = 0 THEN 'Foreman' ELSE NULL END AS job_title,
               CASE WHEN user_id % 4 = 0 THEN NULL ELSE concat('+000 ', CAST(user_id AS STRING)) END AS mobile_phone,
               CAST(1000 + user_id AS STRING) AS pin, concat('E', CAST(user_id AS STRING)) AS barcode,
               CASE WHEN user_id % 9 = 8 THEN NULL ELSE CAST(user_id % 9 AS INT) END AS department_id,
               CASE WHEN user_id % 2 = 0 THEN user_id ELSE user_id - 1 END AS user_id, user_id % 15 <> 14 AS active
        FROM (SELECT DISTINCT user_id FROM events) t""",
    "hr_attendance": """
        SELECT event_id AS id, user_id AS employee_id, ts AS check_in, nx AS check_out
        FROM (SELECT event_id, user_id, ts, lead(ts) OVER w AS nx, row_number() OVER w AS rn FROM events
              WINDOW w AS (PARTITION BY user_id, CAST(ts - INTERVAL 6 HOUR AS DATE) ORDER BY ts, event_id)) t
        WHERE rn % 2 = 1""",
    "messages": """
        SELECT concat('d', CAST(doc_id AS STRING)) AS id, concat(source, '@example.com') AS mailbox,
               concat('u', CAST(doc_id % 37 AS STRING), '@example.com') AS sender,
               split_part(text, chr(10), 1) AS subject, text AS body,
               DATE '2024-01-01' + CAST(doc_id % 400 AS INT) AS received
        FROM documents
        UNION ALL
        SELECT concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)), concat(role, '@example.com'),
               concat('v', CAST(conv_id % 11 AS STRING), '@example.com'), split_part(text, chr(10), 1), text,
               DATE '2024-01-01' + CAST(conv_id % 400 AS INT)
        FROM conversations""",
    "report_files": """
        SELECT concat(event_type, '_report_', lpad(CAST(20240100 + day(ts) AS STRING), 8, '0'), '_',
                      lpad(CAST(hour(ts) * 100 + minute(ts) AS STRING), 4, '0'), '.csv') AS file_name,
               ts AS mtime, CAST(floor(value * 100) AS BIGINT) AS size_bytes
        FROM events""",
    "log_lines": """
        SELECT concat('job', CAST(user_id % 7 AS STRING), '.log') AS file_name, ts AS mtime, event_id AS line_no,
               concat(' ', CASE event_type WHEN 'error' THEN 'Error' ELSE 'INFO' END, ' - ', event_type, ' ', props) AS value
        FROM events""",
}


def needed(text: str) -> list[str]:
    """Views a statement uses, directly or through other views, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in found and re.search(rf"\b{name}\b", sql):
                if VIEWS[name] is not sql:
                    visit(VIEWS[name])
                    if name not in found:
                        found.append(name)

    visit(text)
    return found


def with_views(body: str) -> str:
    """A statement preceded by the views it uses, for DuckDB."""
    ctes = [f"{name} AS ({VIEWS[name]})" for name in needed(body)]
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body


_tables: dict[tuple[str, str], Tables] = {}
_sources: dict[tuple[str, str, str], DataFrame] = {}
_sizes: dict[tuple[str, str, str], TableSize | None] = {}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table. Its plan is kept per application, so that its footer is read only once."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _sources:
        _sources[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _sources[key]


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One view over the test tables of a folder."""
    text = VIEWS[name]
    for table in SOURCES:
        reads = rf"\b(FROM|JOIN)\s+{table}\b"
        if re.search(reads, text):
            source(spark, folder, table).createOrReplaceTempView(f"ledgerloom_{table}")
            text = re.sub(reads, rf"\1 ledgerloom_{table}", text)
    return spark.sql(text)


def source_size(spark: SparkSession, folder: str, name: str) -> TableSize | None:
    """Size of a test table, kept as long as its plan once it is known."""
    key = (spark.sparkContext.applicationId, folder, name)
    if _sizes.get(key) is None:
        _sizes[key] = table_size(source(spark, folder, name))
    return _sizes[key]


def view_size(spark: SparkSession, folder: str, name: str) -> TableSize | None:
    """Size of a view: its rows are at most those of the tables it names, each time it names them; lists are short."""
    names = re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", VIEWS[name])
    sizes = [view_size(spark, folder, n) if n in VIEWS else source_size(spark, folder, n) for n in names]
    if any(s is None for s in sizes):
        return None
    listed = VIEWS[name].count("), (") + 1 if "VALUES" in VIEWS[name] else 0
    return TableSize(listed + sum(s.rows for s in sizes), row_bytes(erp(spark, folder)[name].schema))


def erp(spark: SparkSession, folder: str) -> Tables:
    """All ERP tables over the test tables of a folder (their plans, kept per application)."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = Tables(
            lambda name: view(spark, folder, name), VIEWS, lambda name: view_size(spark, folder, name))
    return _tables[key]
