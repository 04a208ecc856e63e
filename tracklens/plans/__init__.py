"""The batch's user-level jobs, put together from the operators."""

from tracklens.plans.audit import Audit
from tracklens.plans.create import candidate_counts, create_candidates
from tracklens.plans.daily import (
    DailyTables,
    run_create,
    run_daily,
    run_detect,
    run_merge,
    run_publish,
    run_refresh,
)
from tracklens.plans.ledger import Ledger
from tracklens.plans.refresh import append_source, audit_counts, refresh_target, with_source
from tracklens.plans.reports import candidate_report, log_verdict_summary, track_statistics
from tracklens.plans.transcribe import score_in_waves
from tracklens.plans.upload import track_metrics, upload_metrics

__all__ = [name for name in dir() if not name.startswith("_")]
