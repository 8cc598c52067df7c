"""Writers."""

from .fact_store import FactStore
from .kpi_store import KpiStore
from .ledger import BatchLedger
from .schema_log import EvolvingTable
from .snapshots import SnapshotStore
from .tables import (
    append_months,
    append_run,
    publish,
    published_version,
    read_published,
    replace_months,
    replace_run,
    replace_runs,
    union_evolved,
)
from .version_store import VersionStore

__all__ = [
    "BatchLedger",
    "EvolvingTable",
    "FactStore",
    "KpiStore",
    "SnapshotStore",
    "VersionStore",
    "append_months",
    "append_run",
    "publish",
    "published_version",
    "read_published",
    "replace_months",
    "replace_run",
    "replace_runs",
    "union_evolved",
]
