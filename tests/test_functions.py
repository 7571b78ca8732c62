"""Hand-made goldens of the scalar logic, and comparisons with Python's own html and re."""

import datetime as dt
import html
import re
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, status, text

V = F.col("v")
DAY = dt.date(1998, 6, 15)


def test_localized(column):
    values = ['{"es_GT":"uno","en_US":"one"}', '{"en_US":"one"}', '{"fr":"un"}', "plain", '{"es_GT":""}', None]
    assert column(values, text.localized(V)) == ["uno", "one", '{"fr":"un"}', "plain", "", None]
    assert column(values, text.localized_only(V)) == ["uno", None, None, None, "", None]
    assert column(values, text.localized_nonblank(V)) == ["uno", "one", '{"fr":"un"}', "plain", '{"es_GT":""}', ""]


def test_html_references_equal_python(column):
    import random
    from html.entities import html5

    rng = random.Random(1)
    codes = [*range(300), 0xD800, 0xFFFE, 0xFDD0, 0x1FFFF, 0x110000, 99_999_999_999, 128512]
    texts = [f"&{n}" for n in html5] + [f"&#{n};" for n in codes] + [f"&#x{n:x} " for n in codes]
    texts += ["", "&", "&&", "a & b", "&#;", "&#xg;", "&notit;", "&amp;lt;", "&nosuch;", "&ltgt;", "&#0065;&#X41;"]
    texts += ["".join(rng.choices(["&", "#", "x", "amp", "lt", ";", "a", " ", "6", "notin", "é", "\n"], k=rng.randrange(14))) for _ in range(1000)]
    assert column([*texts, None], text.decode_entities(V)) == [*map(html.unescape, texts), None]


def test_days_are_whole_texts(column):
    values = ["2024-01-02", "2024-01-02T10:00:00", "2024-01-02 10:00", "2024-01-02garbage", "2024-13-01", "x2024-01-02", "", None, "20240102"]
    day = dt.date(2024, 1, 2)
    assert column(values, dates.parse_day(V)) == [day, day, day, None, None, None, None, None, None]


CONTROLS = "a\x00b\tc\nd\re\x1ff\x7fg h"


def test_strip_control_modes(column):
    assert column([CONTROLS], text.strip_control(V, "all")) == ["abcdefg h"]
    assert column([CONTROLS], text.strip_control(V, "keep_layout")) == ["ab\tc\nd\refg h"]
    assert column([CONTROLS + "\r\n"], text.strip_control(V, "one_line")) == ["ab\tc d ef\x7fg h "]


def python_squash(value):
    value = "".join(ch for ch in value if ord(ch) >= 32 or ch in "\t\n\r").replace("\r\n", "\n").replace("\r", "\n")
    lines = [" ".join(line.split()) for line in value.split("\n")]
    return "\n".join(line for line in lines if line)


def python_html_lines(value, squeeze):
    value = html.unescape(value)
    value = re.sub(r"</p>", "\n", re.sub(r"<br\s*/?>", "\n", value, flags=re.I), flags=re.I)
    value = re.sub(r"\n\s*\n", "\n", re.sub(r"<[^>]+>", "", value)).strip()
    return (re.sub(" +", " ", value) if squeeze else value).strip()


def python_html_summary(value):
    value = " ".join(re.sub("<.*?>", "", value).split())
    for entity, char in text.COMMON_ENTITIES:
        value = value.replace(entity, char)
    return (value if len(value) <= 200 else value[:197] + "...").strip()


PIECES = st.sampled_from(["a", "é", " ", "  ", "\t", "\n", "\r\n", " ", "<b>", "</p>", "<br/>", "<BR >", "&lt;", "&amp;",
                          "&nbsp;", "&eacute;", "&#233;", "<i\nx>", "\x01", "\x7f", ".", "x" * 60, "&quot;", "<", ">"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=20, max_size=40))
def test_cleaners_agree_with_python(column, texts):
    assert column(texts, text.squash_lines(V)) == [python_squash(x) for x in texts]
    assert column(texts, text.html_to_lines(V)) == [python_html_lines(x, True) for x in texts]
    assert column(texts, text.html_to_lines(V, squeeze_spaces=False)) == [python_html_lines(x, False) for x in texts]
    assert column(texts, text.html_to_summary(V)) == [python_html_summary(x) for x in texts]


def test_html_edges(column):
    values = ["&lt;b&gt;x", "<p>a</p><p>b</p>", None, "x" * 200, "y" * 201]
    assert column(values[:3], text.html_to_lines(V)) == ["x", "a\nb", ""]
    assert column(values, text.html_to_summary(V)) == ["<b>x", "ab", "", "x" * 200, "y" * 197 + "..."]


def test_number_or_zero(column):
    values = ["12", " 3.5kg", "-2e2x", ".5", "n/a", "", None, "1,000"]
    assert column(values, text.number_or_zero(V)) == [12.0, 3.5, -200.0, 0.5, 0.0, 0.0, 0.0, 1.0]


def test_stable_file_name(column):
    values = ["Cash_Flow_20260407_171437.xlsx", "control_obra_20260407_0630.xlsx", "plain.csv", "x__20260407_171437.json",
              "x_2026_04.csv"]
    assert column(values, text.stable_file_name(V)) == ["Cash_Flow.xlsx", "control_obra.xlsx", "plain.csv", "x.json", "x_2026_04.csv"]


def test_labels(column):
    assert column([0, 1, 1023, 1024, 1536, 1048576, None], text.file_size_label(V), "v bigint") == [
        "N/A", "1 B", "1023 B", "1.0 KB", "1.5 KB", "1.0 MB", "N/A"]
    assert column([1499.0, 1500.0, 0.0], text.thousands_label(V), "v double") == ["Q1K", "Q2K", "Q0K"]
    amounts = [D("1234.565"), D("0"), None, D("-5.5"), D("0.125")]
    assert column(amounts, money.money_label(V), "v decimal(18,3)") == ["Q1,234.57", "", "", "Q-5.50", "Q0.13"]


def test_erp_link(column):
    link = text.erp_link("http://x/#", V, project=False)
    assert column(["P12", "7", "abc", None], F.regexp_extract(link, "id=([0-9]+)&", 1)) == ["12", "7", "0", "0"]
    assert column(["7"], text.erp_link("http://x/#", V, project=False, project_id=F.lit(3))) == [
        "http://x/#id=7&cids=1&menu_id=385&action=557&active_id=3&model=project.task&view_type=form"]


PO_DDL = "ordered decimal(18,4), invoiced decimal(18,4), received decimal(18,4), unpaid decimal(18,4)"


def test_order_line_status(column):
    rows = [(10, None, None, 5), (10, 0, 0, 5), (10, 4, 3, 5), (10, 10, 10, 5), (10, 10, 12, 0), (10, 10, 10, None)]
    rows = [tuple(None if v is None else D(v) for v in r) for r in rows]
    c = F.col
    pending = money.line_pending(c("ordered"), c("invoiced"), F.lit(2), F.lit(20), c("unpaid"))
    assert [int(x) for x in column(rows, pending, PO_DDL)] == [20, 20, 12, 5, 0, 0]
    assert column(rows, status.payment_status(c("invoiced"), c("ordered"), c("unpaid")), PO_DDL) == [
        "Not Invoiced", "Not Invoiced", "Partially Invoiced", "Invoiced - Unpaid", "Paid", "Paid"]
    assert column(rows, status.reception_status(c("received"), c("ordered")), PO_DDL) == [
        "Not Received", "Not Received", "Partially Received", "Fully Received", "Fully Received", "Fully Received"]
    assert column(rows, status.reception_status(c("received"), c("ordered"), False), PO_DDL)[0] == "Fully Received"


def test_order_reference(column):
    rows = [("P1", "draft", "USD"), ("P2", "draft", "GTQ"), ("P3", "purchase", "USD"), ("P4", "purchase", None)]
    ref = money.order_reference(F.col("n"), F.col("s"), F.col("c"), F.lit(D("10.5")))
    assert column(rows, ref, "n string, s string, c string") == ["RFQ-P1 ($10.50)", "RFQ-P2", "P3 ($10.50)", "P4"]


def test_movement_type_order(column):
    rows = [(8, 8, "internal", "internal"), (1, 8, "supplier", "internal"), (8, 1, "internal", "customer"),
            (1, 2, "supplier", "customer"), (1, 2, "internal", "customer"), (1, 2, "internal", "production"),
            (1, 2, "inventory", "internal"), (1, 2, None, "inventory"), (1, 2, None, None)]
    c = F.col
    kind = status.movement_type(c("a"), c("b"), c("ua"), c("ub"))
    assert column(rows, kind, "a int, b int, ua string, ub string") == [
        "Stock In", "Stock In", "Stock Out", "Receipt from Supplier", "Delivery to Customer", "Production Movement",
        "Inventory Adjustment", "Inventory Adjustment", "Internal Transfer"]


@pytest.mark.parametrize("available, low, high, level", [
    (0, 10, 20, "critical"), (10, 10, 20, "low"), (11, 10, 20, "ok"), (30, 10, 20, "ok"), (31, 10, 20, "over"),
    (99, 10, 0, "ok"), (0, 0, 20, "critical"), (99, 0, 20, "ok"), (-1, 0, 0, "critical")])
def test_stock_level(column, available, low, high, level):
    got = column([(float(available), float(low), float(high))], status.stock_level(F.col("a"), F.col("l"), F.col("h")),
                 "a double, l double, h double")
    assert got == [level]


def test_dwell_alert(column):
    hour = 3_600_000_000
    values = [10 * hour, 10 * hour + 1_000_000, 12 * hour, 12 * hour + 1_000_000]
    assert column(values, status.dwell_alert(V), "v bigint") == ["normal", "warning", "warning", "danger"]


def test_schedule(column):
    rows = [(-1, "Bloqueado"), (0, "BLOCKED"), (0, "x"), (3, "x"), (4, "x"), (None, "x")]
    assert column(rows, status.schedule_class(F.col("d"), F.col("s")), "d int, s string") == [
        "overdue", "blocked", "due_soon", "due_soon", "none", "none"]
    flags = [(-1, False), (-1, True), (-1, None), (0, False), (None, False)]
    assert column(flags, status.is_overdue(F.col("d"), F.col("c")), "d int, c boolean") == [True, False, False, False, False]
    assert column(["Hecho", "hecho ", None, "DONE"], status.is_completed(V)) == [True, False, False, False]


def test_day_arithmetic(column):
    days = [DAY + dt.timedelta(days=n) for n in (-1, 0, 1)] + [None]
    assert column(days, dates.days_overdue(V, DAY), "v date") == [1, 0, 0, 0]
    assert column(days, dates.days_until(V, DAY), "v date") == [-1, 0, 1, None]
    assert column(days, dates.days_until_floor(V, dt.datetime(1998, 6, 15, 0, 1)), "v date") == [-2, -1, 0, None]


def test_week_index(column):
    monday = dates.week_start(dt.date(1998, 6, 18))
    assert monday == DAY
    offsets = [-1, 0, 6, 7, 12 * 7 + 6, 13 * 7]
    days = [monday + dt.timedelta(days=n) for n in offsets]
    assert column(days, dates.week_index(V, monday), "v date") == [-1, 0, 0, 1, 12, 13]
    assert column([DAY], dates.week_label(V), "v date") == ["Semana 15/06 - 21/06"]


def test_local_day_and_hours(column):
    stamps = [dt.datetime(2024, 1, 16, 5, 59, 59), dt.datetime(2024, 1, 16, 6, 0)]
    assert column(stamps, dates.local_date(V, "America/Guatemala"), "v timestamp_ntz") == [dt.date(2024, 1, 15), dt.date(2024, 1, 16)]
    assert column(stamps, dates.clock(V, "America/Guatemala"), "v timestamp_ntz") == ["23:59:59", "00:00:00"]
    spans = [0, 18_000_000, 17_999_999, 3_618_000_000]
    assert column(spans, dates.hours(V), "v bigint") == [0.0, 0.01, 0.0, 1.01]
    pairs = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1, 1, 2, 3, 4))]
    got = column(pairs, dates.micros_between(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz")
    assert got == [(pairs[0][1] - pairs[0][0]) // dt.timedelta(microseconds=1)]


def test_micros_do_not_depend_on_session_zone(spark, column):
    pairs = [(dt.datetime(2024, 3, 10, 1), dt.datetime(2024, 3, 10, 4))]  # a clock change in this zone
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = column(pairs, dates.micros_between(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [3 * 3_600_000_000]


def test_freshness(column):
    rows = [(None, 1), (27.0, 0), (26.0, 0), (1.0, 1)]
    assert column(rows, status.freshness(F.col("a"), F.col("m")), "a double, m int") == ["missing", "stale", "ok", "partial"]
