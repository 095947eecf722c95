"""Writers: staged full replace, CSV export, run audit."""

from tenure.sinks.audit import Audit
from tenure.sinks.replace import Written, new_run_id, replace_table

__all__ = ["Audit", "Written", "new_run_id", "replace_table"]
