"""Label back-fill: fills ACTUAL_LABEL of mature monitor rows once their outcome is known. Repeating it labels nothing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from lodemark.operators.encode import require_columns
from lodemark.operators.labels import label_counts, label_updates, refuse_ambiguous
from lodemark.plans.shared import as_time, time_column
from lodemark.sources.scans import shared_folder
from lodemark.sources.store import Store

PROCEDURE = "GROUND_TRUTH_MERGE"


def backfill_labels(store: Store, outcomes: DataFrame, now: datetime | str) -> dict[str, int]:
    """Counts before and after, also as one row in the log; a failure is logged as FAILED and raised."""
    shared_folder(store.spark)
    use_case, rules = store.use_case, store.use_case.retrain
    key, label, ts = use_case.outcome_key, rules.outcome_label, rules.outcome_ts
    try:
        require_columns(outcomes, [key, label, *([ts] if ts else [])], "outcome source")
        refuse_ambiguous(outcomes, key, label, ts)
        monitor = store.monitor()
        counts = label_counts(monitor).first()
        updates = label_updates(monitor, outcomes, key, label, use_case.task, time_column(now), ts, rules.respect_maturity)
        new = store.add_labels(updates.select("RUN_ID", "FEED_ROW_ID", "GT_LABEL"), time_column(now))
    except Exception as e:
        store.log(PROCEDURE, 0, "FAILED", str(e), as_time(now))
        raise
    waiting = counts["WAITING"] - new
    store.log(PROCEDURE, new, "OK", f"labeled {new} rows, {waiting} still waiting", as_time(now))
    return {"total_rows": counts["TOTAL_ROWS"], "labeled_before": counts["LABELED"], "labeled_after": counts["LABELED"] + new,
            "newly_labeled": new, "still_unlabeled": waiting}
