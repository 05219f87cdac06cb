"""The scheduled report job: gate, build, queue.

1. Data gate: any subscriber row in the trailing window (all types).
2. Calendar gate: the business calendar's weekday name for ``as_of`` is a run day
   (no calendar row keeps the gate closed; two rows raise).
3. Build the report (one pass per fact table) and its outbox record.
4. Replace by subject in the outbox table.

One instant decides everything: the day of the gates, of the window and of the
subject is its UTC date (or the configured ``as_of``), and the record date is its
date at the fixed offset.  The two gates are one-row results read on the driver;
everything else stays in Spark.  Returns whether a mail was queued.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.periods import DEFAULT_RUN_DAYS, local_date
from monthwise.operators import gating as G
from monthwise.operators.outbox import outbox_row
from monthwise.plans.report import ReportBase, ReportConfig, report_mail
from monthwise.session import materialize, released
from monthwise.sources.month_parts import MonthParts
from monthwise.sources.outbox_store import OutboxStore

RECORD_OFFSET = "-03:00"


def _at(cfg: ReportConfig, now: dt.datetime | None) -> tuple[ReportConfig, dt.datetime]:
    """The settings with their day fixed, and the run's instant in UTC."""
    now = (now or dt.datetime.now(dt.timezone.utc)).astimezone(dt.timezone.utc)
    return replace(cfg, as_of=cfg.as_of if cfg.as_of is not None else now.date()).frozen(), now


def _queue(base: ReportBase, store: OutboxStore, now: dt.datetime, to: str, cc: str | None, template) -> None:
    recorded = local_date(F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz"), RECORD_OFFSET)
    mail = report_mail(base) if template is None else report_mail(base, template)
    store.replace(materialize(outbox_row(mail, to, cc, recorded), "outbox-row"), "SUBJECT")


def run_report_trigger(subscribers: DataFrame, transactions: DataFrame, calendar: DataFrame,
                       store: OutboxStore, cfg: ReportConfig, to: str, cc: str | None = None,
                       days: Sequence[str] = DEFAULT_RUN_DAYS, template=None,
                       now: dt.datetime | None = None) -> bool:
    """``now``: the run's instant with its time zone (default: the clock, read once)."""
    cfg, now = _at(cfg, now)
    if not G.has_recent_data(subscribers, "PERIODO", cfg.as_of, cfg.n_back):
        return False
    if not G.calendar_gate(calendar, cfg.as_of, days).first().gate_open:
        return False
    with released(store.spark):
        _queue(ReportBase.from_rows(subscribers, transactions, cfg), store, now, to, cc, template)
    return True


def run_report_from_parts(subscribers: MonthParts, transactions: MonthParts, calendar: DataFrame,
                          store: OutboxStore, cfg: ReportConfig, to: str, cc: str | None = None,
                          days: Sequence[str] = DEFAULT_RUN_DAYS, template=None,
                          now: dt.datetime | None = None) -> bool:
    """The same job on maintained month parts: if the calendar's gate is open, months whose facts
    changed since the last run are summed again, and gate and report read the parts alone."""
    cfg, now = _at(cfg, now)
    if not G.calendar_gate(calendar, cfg.as_of, days).first().gate_open:
        return False
    subscribers.refresh()
    transactions.refresh()
    if not G.has_recent_data(subscribers.read(), "PERIODO", cfg.as_of, cfg.n_back):
        return False
    with released(store.spark):
        _queue(ReportBase.from_parts(subscribers.read(), cfg, transactions.read()), store, now, to, cc, template)
    return True
