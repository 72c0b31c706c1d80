"""Generic DataFrame operators (top-1, pivot, forward fill, snapshots, gates, checks)."""

from ratebridge.operators.gates import GateError, missing_members, require_members, require_rows  # noqa: F401
from ratebridge.operators.reshape import ffill, pivot_series  # noqa: F401
from ratebridge.operators.snapshot import attach_snapshot, latest_complete  # noqa: F401
from ratebridge.operators.status import severity, with_freshness, worst_status  # noqa: F401
from ratebridge.operators.topk import asc, dedup_keep_first, desc, first_per_key, latest_per_key  # noqa: F401
