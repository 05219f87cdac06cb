"""The outbox drain: every pending row is offered on every run.

One run reads all rows with status 'N' from the outbox table, hands them to the
caller's ``deliver`` function and marks the keys that it delivered with one
set-based rewrite.  The table is the only state: a row that failed to send, or was
queued just before a crash, is still pending and so is offered again
(at least once, as the polling loop was).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from monthwise.session import materialize, release
from monthwise.sources.outbox_store import OutboxStore


def drain_once(store: OutboxStore, deliver: Callable[[DataFrame], DataFrame], key: str = "SUBJECT") -> int:
    """Offer all pending rows once.  ``deliver(pending_rows) -> DataFrame[key]`` sends
    mail (outside this library) and returns the keys it delivered; that frame is
    evaluated exactly once.  Returns the number of distinct keys delivered."""
    todo = materialize(store.pending(), "drain-pending")
    try:
        sent = materialize(deliver(todo).select(key).where(f"{key} is not null").distinct(), "drain-sent")
        try:
            n = sent.count()
            if n:
                store.mark_processed(sent, key)
            return n
        finally:
            release(sent)
    finally:
        release(todo)
