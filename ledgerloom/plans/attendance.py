"""Attendance: who is on site, daily movements, sessions, breaks, hours, overtime.

``check_in`` and ``check_out`` are naive UTC; a local day is the day in the site's zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions.dates import (
    clock, day, hours, instant, local_date, local_time, micros_between, week_start, within_local_days,
)
from ..functions.status import dwell_alert, presence
from ..operators.groups import list_cell, list_parts
from ..operators.joins import look_up
from ..operators.ordered import numbered, one_per_key, with_next
from ..params import AsOf, BreakRule
from ..sources.sizes import fits

NO_DEPARTMENT = "Sin Departamento"
Departments = tuple[str, ...] | None


def staff(t: Mapping[str, DataFrame], departments: Departments = ref.TRACKED_DEPARTMENTS) -> DataFrame:
    """Employees with their department. ``None`` takes all and names the missing department."""
    units = t["hr_department"].select(F.col("id").alias("department_id"), F.col("name").alias("department_name"))
    people = t["hr_employee"].select(
        F.col("id").alias("employee_id"), F.col("name").alias("employee_name"), "job_title",
        F.col("mobile_phone").alias("phone"), F.col("pin").alias("access_pin"),
        F.col("barcode").alias("employee_code"), "department_id", "active")
    df = people.join(units, "department_id", "left").drop("department_id")
    if departments is None:
        return df.withColumn("department_name", F.coalesce("department_name", F.lit(NO_DEPARTMENT)))
    return df.filter(F.col("department_name").isin(*departments))


def site_roster(t: Mapping[str, DataFrame], departments: Departments = ref.TRACKED_DEPARTMENTS) -> DataFrame:
    """Active employees of the tracked departments."""
    return staff(t, departments).filter("active").drop("active").distinct().orderBy(
        "department_name", "employee_name", "employee_id")


def _sessions(t: Mapping[str, DataFrame], tz: str, first: dt.date, last: dt.date) -> DataFrame:
    """Sessions that begin on a local day of the range, with that day."""
    kept = t["hr_attendance"].filter(within_local_days(F.col("check_in"), tz, first, last))
    return kept.withColumn("work_date", local_date(F.col("check_in"), tz))


def _who(df: DataFrame, t: Mapping[str, DataFrame], departments: Departments) -> DataFrame:
    return df.join(staff(t, departments).select("employee_id", "employee_name", "department_name"), "employee_id")


def on_site_now(t: Mapping[str, DataFrame], as_of: AsOf, departments: Departments = ref.TRACKED_DEPARTMENTS) -> DataFrame:
    """Employees whose last session of the day is still open, longest first, with a dwell alert."""
    today = _sessions(t, as_of.tz, as_of.date, as_of.date).drop("work_date")
    last = one_per_key(today, ["employee_id"], [F.desc("check_in"), F.desc("id")])
    inside = last.withColumn("current_status", presence(F.col("check_in"), F.col("check_out"))).filter(
        "current_status = 'INSIDE'")
    people = _who(inside, t, departments)
    roster = staff(t, departments).filter("active").select(
        F.col("employee_id").alias("_id"), F.coalesce(F.nullif("phone", F.lit("")), F.lit("N/A")).alias("_phone"))
    people = look_up(people, roster, "employee_id", "roster", {"_phone": "phone"}, key="_id",
                     small=fits(t, "hr_employee"))
    since = micros_between(F.col("check_in"), instant(as_of.ts))
    order = [F.col("check_in"), F.col("employee_id")]
    return numbered(people, order).select(
        "row_no", "employee_id", "employee_name", "department_name",
        local_time(F.col("check_in"), as_of.tz).alias("entry_time"),
        clock(F.col("check_in"), as_of.tz, "HH:mm").alias("entry_clock"),
        hours(since, 1).alias("hours_on_site"), dwell_alert(since).alias("alert_level"), "phone", "current_status",
    )


def site_status(on_site: DataFrame, as_of: AsOf) -> DataFrame:
    """Head count and alerts of the people on site, in one row."""
    return on_site.agg(
        F.lit(as_of.date).cast("date").alias("report_date"), F.count(F.lit(1)).alias("currently_on_site"),
        *[F.count_if(F.col("alert_level") == level).alias(level) for level in ("danger", "warning", "normal")])


def daily_movements(t: Mapping[str, DataFrame], as_of: AsOf, departments: Departments = ref.TRACKED_DEPARTMENTS) -> DataFrame:
    """All sessions of the day with duration and state; order them by entry, newest first."""
    rows = _who(_sessions(t, as_of.tz, as_of.date, as_of.date), t, departments)
    still = F.col("check_out").isNull()
    return rows.select(
        F.col("id").alias("record_id"), "employee_id", "employee_name", "department_name",
        local_time(F.col("check_in"), as_of.tz).alias("entry_time"),
        local_time(F.col("check_out"), as_of.tz).alias("exit_time"),
        F.when(still, "STILL_INSIDE").otherwise("COMPLETED").alias("status"),
        hours(micros_between(F.col("check_in"), F.col("check_out")), 1).alias("duration_hours"),
    )


def _closed_micros() -> Column:
    """Length of a session; an open one counts 0."""
    return F.coalesce(micros_between(F.col("check_in"), F.col("check_out")), F.lit(0))


def period_attendance(t: Mapping[str, DataFrame], as_of: AsOf, first: dt.date, last: dt.date,
                      departments: Departments = ref.TRACKED_DEPARTMENTS) -> DataFrame:
    """Per employee and day: first entry, last exit, hours of closed sessions, missing exits."""
    days = _sessions(t, as_of.tz, first, last).groupBy("employee_id", "work_date").agg(
        F.min("check_in").alias("first_entry"), F.max("check_out").alias("last_exit"),
        F.sum(_closed_micros()).alias("worked_micros"), F.count_if(F.col("check_out").isNull()).alias("open_sessions"))
    return _who(days, t, departments).select(
        "employee_id", "employee_name", "department_name", "work_date",
        local_time(F.col("first_entry"), as_of.tz).alias("first_entry"),
        local_time(F.col("last_exit"), as_of.tz).alias("last_exit"),
        F.lit(1).alias("days_present"), "worked_micros", hours(F.col("worked_micros")).alias("total_hours"),
        (F.col("open_sessions") > 0).alias("missing_exit"))


def week_range(as_of: AsOf) -> tuple[dt.date, dt.date]:
    """Monday of the week through the report date."""
    return week_start(as_of.date), as_of.date


def week_overtime(period: DataFrame, weekly_hours: int = ref.WEEKLY_REGULAR_HOURS) -> DataFrame:
    """Per employee and week (its Monday): days, hours, overtime, days with a missing exit."""
    regular = weekly_hours * 3_600_000_000
    extra = F.greatest(F.col("worked") - F.lit(regular), F.lit(0))
    monday = F.date_trunc("week", F.col("work_date")).cast("date").alias("week_start")
    return (
        period.groupBy("employee_id", "employee_name", "department_name", monday).agg(
            F.sum("days_present").alias("days"), F.sum("worked_micros").alias("worked"),
            F.count_if("missing_exit").alias("missing_exits"))
        .withColumns({"total_hours": hours(F.col("worked")), "overtime_hours": hours(extra)}).drop("worked")
    )


# --- sessions per employee and day -----------------------------------------------------------

def trailing_range(as_of: AsOf, days: int = 30) -> tuple[dt.date, dt.date]:
    return as_of.date - dt.timedelta(days=days), as_of.date


def attendance_sessions(t: Mapping[str, DataFrame], as_of: AsOf, *, days: int = 30,
                        departments: Departments = None, breaks: BreakRule = BreakRule(),
                        open_hours: str = "add", cut: str = "hour") -> DataFrame:
    """Per employee and local day: hours, break hours, first entry, last exit, still inside.

    ``open_hours='add'`` adds the running session to the closed ones on the report date only;
    ``'replace'`` makes the running session the total of any day that ends with one;
    ``'ignore'`` counts closed sessions only. ``cut`` is the unit a person's day is divided by
    while gaps are found; a finer one spreads a badge with very many records further.
    """
    first, last = trailing_range(as_of, days)
    sessions = _sessions(t, as_of.tz, first, last)
    chained = with_next(sessions, ["employee_id", "work_date"], ["check_in", "id"], "check_in",
                        F.date_trunc(cut, F.col("check_in")), "next_in")
    gap = micros_between(F.col("check_out"), F.col("next_in"))
    counts = gap.isNotNull()
    if breaks.shortest is not None:
        counts = counts & (gap >= breaks.shortest * 1_000_000)
    if breaks.longest is not None:
        counts = counts & (gap <= breaks.longest * 1_000_000)
    per_day = chained.groupBy("employee_id", "work_date").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum(_closed_micros()).alias("closed"),
        F.coalesce(F.sum(F.when(counts, gap)), F.lit(0)).alias("paused"),
        F.max_by(F.col("check_out").isNull(), F.col("check_in")).alias("is_currently_inside"),
        F.min("check_in").alias("first_in"), F.max("check_in").alias("last_in"),
        F.max_by("check_out", F.when(F.col("check_out").isNotNull(), F.col("check_in"))).alias("last_out"),
    )
    running = micros_between(F.col("last_in"), instant(as_of.ts))
    inside = F.col("is_currently_inside")
    if open_hours == "add":
        total = F.col("closed") + F.when(inside & (F.col("work_date") == day(as_of.date)), running).otherwise(0)
    elif open_hours == "replace":
        total = F.when(inside, running).otherwise(F.col("closed"))
    else:
        total = F.col("closed")
    return _who(per_day, t, departments).select(
        "work_date", "employee_id", "employee_name", F.col("department_name").alias("department"), "sessions",
        hours(total).alias("total_hours"), hours(F.col("paused")).alias("lunch_duration"),
        hours(total).alias("effective_hours"), "is_currently_inside",
        clock(F.col("first_in"), as_of.tz).alias("first_entry"), clock(F.col("last_out"), as_of.tz).alias("last_exit"))


def clock_records(t: Mapping[str, DataFrame], as_of: AsOf, days: int = 30) -> DataFrame:
    """One row per entry or exit, with its place in the employee's day."""
    sessions = _sessions(t, as_of.tz, *trailing_range(as_of, days))
    events = F.array(
        F.struct(F.lit(0).alias("side"), F.lit("entry").alias("type"), F.col("check_in").alias("at")),
        F.struct(F.lit(1).alias("side"), F.lit("exit").alias("type"), F.col("check_out").alias("at")))
    rows = sessions.select("work_date", "employee_id", "check_in", "id", F.explode(events).alias("e"))
    return rows.filter("e.at is not null").select(
        "work_date", "employee_id",
        F.struct("check_in", "id", F.col("e.side").alias("side"), F.col("e.type").alias("type"),
                 clock(F.col("e.at"), as_of.tz).alias("time")).alias("event"))


def clock_record_parts(t: Mapping[str, DataFrame], as_of: AsOf, days: int = 30) -> DataFrame:
    """All clock records of every employee and day, in parts."""
    return list_parts(clock_records(t, as_of, days), ["work_date", "employee_id"], "event")


def attendance_days(t: Mapping[str, DataFrame], as_of: AsOf, **options) -> DataFrame:
    """The nested attendance document: one row per employee and day with the person's data and clock records."""
    events = clock_records(t, as_of, options.get("days", 30))
    cells = list_cell(events, ["work_date", "employee_id"], "event", "clock_records", "record_count", separator=None)
    cells = cells.withColumn("clock_records", F.transform(
        "clock_records", lambda e: F.struct(e["type"].alias("type"), e["time"].alias("time"))))
    people = t["hr_employee"].select(F.col("id").alias("employee_id"), "job_title", F.col("mobile_phone").alias("phone"))
    days = attendance_sessions(t, as_of, **options).join(people, "employee_id", "left")
    return days.join(cells, ["work_date", "employee_id"], "left")


def attendance_daily(sessions: DataFrame) -> DataFrame:
    """Per day: employees present and still inside."""
    return sessions.groupBy("work_date").agg(
        F.count(F.lit(1)).alias("total_employees"),
        F.count_if("is_currently_inside").alias("currently_inside")).orderBy(F.desc("work_date"))


def attendance_span(t: Mapping[str, DataFrame], as_of: AsOf, days: int = 30, departments: Departments = None) -> DataFrame:
    """Hours from the first entry to the last exit of a day, or to now while inside; no breaks."""
    per_day = _sessions(t, as_of.tz, *trailing_range(as_of, days)).groupBy("employee_id", "work_date").agg(
        F.min("check_in").alias("first_in"), F.max("check_in").alias("last_in"),
        F.max_by(F.coalesce(F.col("check_out"), instant(as_of.ts)), F.col("check_in")).alias("end"),
        F.max_by(F.col("check_out").isNull(), F.col("check_in")).alias("is_currently_inside"))
    span = micros_between(F.col("first_in"), F.col("end"))
    return _who(per_day, t, departments).select(
        "work_date", "employee_id", "employee_name", F.col("department_name").alias("department"),
        hours(span).alias("total_hours"), "is_currently_inside")
