"""Settings: where tables are, what their columns are called, and the defaults of each step."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Columns:
    """Column names of a relations table."""

    record_id: str = "record_id"
    country: str = "country"
    snapshot_date: str = "source_snapshot_date"
    relation_kind: str = "relation_kind"
    relation_role: str = "relation_role"
    party_type: str = "party_type"
    company_id: str = "company_public_id"
    company_name: str = "company_name_norm"
    gold: str = "party_public_id"
    name: str = "party_name"
    share: str = "ownership_share_pct"


@dataclass(frozen=True)
class Settings:
    data: str = "data/relations.parquet"
    work: str = "work"
    index: str | None = None
    columns: Columns = field(default_factory=Columns)
    seed: int = 42

    @classmethod
    def from_env(cls) -> Settings:
        """ER_DATA, ER_WORK and ER_INDEX override the paths."""
        return cls(os.environ.get("ER_DATA", cls.data), os.environ.get("ER_WORK", cls.work), os.environ.get("ER_INDEX"))


#: Blocks of more names than this give no pairs: in deduplication, and in a batch request.
MAX_BLOCK, MAX_BLOCK_BATCH = 60, 200
#: Names of at least STOP_FREQ companies, or shorter than MIN_NAME, are not resolved.
STOP_FREQ, MIN_NAME = 50, 3
UNRESOLVED = -1
#: Thresholds tried by the calibration, and the number of cross-country clusters it aims at.
CALIBRATION_GRID = (0.5, 0.7, 0.9, 0.95, 0.98, 0.99)
CALIBRATION_TARGET = 3693 + 182
EVAL_THRESHOLDS = (0.3, 0.5, 0.7, 0.9, 0.95)
REQUEST_THRESHOLD, TOP_K, MAX_TOP_K, MAX_BATCH = 0.9, 10, 100, 5000
