"""Table operators: each takes and returns DataFrames."""

from tidemark.operators.asof import asof_join
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.hotkeys import lead_within_key
from tidemark.operators.incremental import extract_window, high_water_filter, high_water_mark, stamp_lineage
from tidemark.operators.reduce import broadcast_if_small, only_matching
from tidemark.operators.scd2 import scd2_incremental, scd2_initial
from tidemark.operators.upsert import merge_upsert

__all__ = [
    "asof_join",
    "broadcast_if_small",
    "dedupe_latest",
    "extract_window",
    "high_water_filter",
    "high_water_mark",
    "lead_within_key",
    "merge_upsert",
    "only_matching",
    "scd2_incremental",
    "scd2_initial",
    "stamp_lineage",
]
