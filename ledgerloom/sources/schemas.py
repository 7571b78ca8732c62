"""Columns every mart expects from the ERP tables. ``key`` columns keep the type they arrive with."""

from __future__ import annotations

QTY = "decimal(18,4)"
MONEY = "decimal(18,2)"

TABLES: dict[str, dict[str, str]] = {
    "stock_move": dict(
        id="key", name="string", date="timestamp_ntz", create_date="timestamp_ntz", product_id="key",
        product_uom="key", product_uom_qty=QTY, quantity_done=QTY, price_unit=MONEY, location_id="key",
        location_dest_id="key", state="string", procure_method="string", usage_purpose_id="key",
        origin="string", reference="string", picking_id="key", create_uid="key", write_uid="key",
        purchase_line_id="key", sale_line_id="key", production_id="key", raw_material_production_id="key"),
    "stock_move_line": dict(id="key", move_id="key", lot_id="key"),
    "stock_location": dict(id="key", name="string", complete_name="string", usage="string", warehouse_id="key"),
    "stock_quant": dict(product_id="key", location_id="key", quantity=QTY),
    "stock_picking": dict(id="key", name="string", origin="string", note="string", partner_id="key"),
    "stock_warehouse": dict(id="key", name="string", company_id="key"),
    "res_company": dict(id="key", name="string"),
    "product_product": dict(id="key", product_tmpl_id="key", default_code="string", barcode="string", active="boolean"),
    "product_template": dict(id="key", name="string", type="string", categ_id="key", uom_id="key", active="boolean"),
    "product_category": dict(id="key", name="string", complete_name="string"),
    "uom_uom": dict(id="key", name="string"),
    "ir_property": dict(res_id="string", name="string", value_float=QTY),
    "mrp_production": dict(
        id="key", name="string", state="string", product_id="key", analytic_account_id="key",
        date_planned_start="timestamp_ntz", date_planned_finished="timestamp_ntz"),
    "purchase_order": dict(
        id="key", name="string", partner_ref="string", state="string", date_order="date", date_planned="date",
        amount_total=MONEY, amount_untaxed=MONEY, amount_tax=MONEY, currency_id="key", partner_id="key",
        user_id="key", invoice_status="string", receipt_status="string", internal_notes="string"),
    "purchase_order_line": dict(
        id="key", order_id="key", product_id="key", name="string", product_qty=QTY, qty_received=QTY,
        qty_invoiced=QTY, price_unit=MONEY, price_total=QTY, date_planned="date"),
    "account_move": dict(
        id="key", name="string", ref="string", move_type="string", state="string", payment_state="string",
        invoice_origin="string", invoice_date="date", invoice_date_due="date", date="date",
        amount_total_signed=MONEY, amount_residual_signed=MONEY, currency_id="key", partner_id="key",
        narration="string"),
    "account_move_line": dict(
        id="key", move_id="key", purchase_line_id="key", product_id="key", name="string", display_type="string",
        quantity=QTY, price_unit=MONEY, price_subtotal=MONEY, price_total=QTY, ref="string", sequence="int"),
    "account_move_purchase_order_rel": dict(account_move_id="key", purchase_order_id="key"),
    "account_analytic_account": dict(id="key", name="string"),
    "sale_order": dict(id="key", name="string", date_order="date", state="string", partner_id="key",
                       analytic_account_id="key"),
    "sale_order_line": dict(id="key", order_id="key", name="string"),
    "project_project": dict(id="key", name="string", description="string", date_start="date", date="date",
                            active="boolean"),
    "project_task": dict(
        id="key", name="string", description="string", parent_id="key", project_id="key", stage_id="key",
        sequence="int", fecha_inicio="date", date_deadline="date", date_end="timestamp_ntz", is_closed="boolean",
        progress="decimal(18,4)", planned_hours="decimal(18,4)", effective_hours="decimal(18,4)",
        remaining_hours="decimal(18,4)", active="boolean", analytic_account_id="key"),
    "project_task_type": dict(id="key", name="string"),
    "project_task_user_rel": dict(task_id="key", user_id="key"),
    "project_task_purchase_order_rel": dict(task_id="key", purchase_order_id="key"),
    "task_dependencies_rel": dict(task_id="key", depends_on_id="key"),
    "res_users": dict(id="key", partner_id="key", login="string"),
    "res_partner": dict(id="key", name="string", phone="string", email="string", vat="string"),
    "res_currency": dict(id="key", name="string"),
    "hr_employee": dict(
        id="key", name="string", job_title="string", mobile_phone="string", pin="string", barcode="string",
        department_id="key", user_id="key", active="boolean"),
    "hr_department": dict(id="key", name="string"),
    "hr_attendance": dict(id="key", employee_id="key", check_in="timestamp_ntz", check_out="timestamp_ntz"),
    "messages": dict(id="string", mailbox="string", sender="string", subject="string", body="string",
                     received="date"),
    "report_files": dict(file_name="string", mtime="timestamp_ntz", size_bytes="bigint"),
    "log_lines": dict(file_name="string", mtime="timestamp_ntz", line_no="bigint", value="string"),
}
