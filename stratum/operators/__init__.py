"""DataFrame -> DataFrame operators."""

from stratum.operators.calendar import (gate, gate_dates, holiday_calendar, holiday_dates,
                                        is_date_present, on_holidays, on_workdays, read_calendar)
from stratum.operators.changes import ChangeLog, change_rows, merge_changes, multiset_changes
from stratum.operators.dedup import latest_per_key
from stratum.operators.quality import (accept, any_null, dq_metrics, label_census, null_flag,
                                       reject_reason, split_rows)
from stratum.operators.upsert import merge_into_table, upsert, upsert_table

__all__ = [
    "ChangeLog", "accept", "any_null", "change_rows", "dq_metrics", "gate", "gate_dates",
    "holiday_calendar", "holiday_dates", "is_date_present", "label_census", "latest_per_key",
    "merge_changes", "merge_into_table", "multiset_changes", "null_flag", "on_holidays", "on_workdays", "read_calendar", "reject_reason", "split_rows",
    "upsert", "upsert_table",
]
