"""Where reports, summaries and issues go."""

from pmweave.sinks.publish import publication, published, recover
from pmweave.sinks.reports import read_pm_issues, with_run_id, write_pm_issues, write_pm_report, write_pm_summary

__all__ = [
    "publication", "published", "read_pm_issues", "recover", "with_run_id", "write_pm_issues", "write_pm_report", "write_pm_summary",
]
