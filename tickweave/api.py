"""Public entry points (one import for users)."""

from .operators.bars import (  # noqa: F401
    bar_hash, bars_rejected, bars_valid, dedup_bars, empty_bars, minute_bars, stamp_bars, union_bars,
)
from .operators.quality import gaps, qa_report, qa_report_json, spikes  # noqa: F401
from .operators.slots import (  # noqa: F401
    catalog_upsert, download_manifest, error_batch, expected_slots, next_batch, pair_quota,
    pending_slots, slot_exists, slot_status, worklist,
)
from .operators.status import pair_status, run_counts, slot_counts, status_rollup, storage_size  # noqa: F401
from .plans.backfill import (  # noqa: F401
    ingest, ingest_files, ingest_paths, plan_worklist, progress_totals, save_qa_report, status_report, storage_usage,
    validate, validate_kept,
)
from .plans.load import load, slot_outcome  # noqa: F401
from .plans.merge import merge_bars  # noqa: F401
from .sources.barfiles import import_bar_files, read_bar_files  # noqa: F401
from .sources.barstore import compact_store, read_store, write_store  # noqa: F401
from .sources.catalog import read_catalog, read_hour_maps, write_catalog  # noqa: F401
from .sources.instruments import instruments  # noqa: F401
from .sources.tickfiles import list_tick_files, read_tick_files, write_tick_files  # noqa: F401
from .streaming.incremental import incremental_load  # noqa: F401
