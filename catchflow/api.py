"""
unless it builds a Column. ``from catchflow import api``."""

from __future__ import annotations

from .functions.geometry import polygon_area, polygon_distance, project_rings, reproject as project, set_crs  # noqa: F401
from .functions.nse import nse  # noqa: F401
from .functions.projections import System, move_point, move_rings, to_system  # noqa: F401
from .functions.scalars import (  # noqa: F401
    clamp_to_water_year, hours_since, pad_gage, parse_time, round_columns as round_decimals, round_sigfigs, water_year)
from .jobs import evaluation_job, forcing_job, forcing_output, forecast_job, nexus_map_job, post_process_job, routing_frames_job  # noqa: F401
from .operators.assemble import (  # noqa: F401
    align_forecast, completeness, dedupe_last, drop_vars, duplicates, keep_promised, merge_conflicts, merge_fields,
    required_vars)
from .operators.catalog import date_spine, ids_from_names, list_files as file_catalog, run_paths as hourly_paths  # noqa: F401
from .operators.compare import head_tail, in_range, in_span, label_union, profile, sample_ids, slice_year  # noqa: F401
from .operators.coverage import (  # noqa: F401
    cells_in_extent, coverage, extent_cells, fill_nearest, flatten_coverage, nested_coverage, total_bounds, unravel,
    without_cells)
from .operators.evaluate import (  # noqa: F401
    ensemble_mean, ensemble_wide, feature_stats, first_nonzero, join_three, nse_table, position_index as feature_index,
    top_feature, with_mean_member)
from .operators.forcing import basin_mean, catchment_mean, catchment_mean_long, prepare_coverage, to_long, to_wide  # noqa: F401
from .operators.ledger import compact as compact_ledger, pending, read_ledger, record  # noqa: F401
from .operators.maps import last_value, map_table, power_norm, rescale, step_table  # noqa: F401
from .operators.pack import from_dense, to_dense  # noqa: F401
from .operators.post import cached_coverage, compile_gage  # noqa: F401
from .publish import compact as compact_manifest, manifest, published, vacuum  # noqa: F401
from .sinks import (  # noqa: F401
    write_basin_series, write_catchment_series, write_coverage, write_dense, write_gage_series, write_raster,
    write_rounded, write_water_years)
from .sinks import write_catchment_series as write_series  # noqa: F401
from .sources.chunks import chunk_errors, scan_chunks, scan_raster  # noqa: F401
from .sources.containers import container_errors, scan_divides  # noqa: F401
from .sources.series import scan_daily_basin_files, scan_nexus, scan_raster_table, scan_routed, scan_series  # noqa: F401
from .streaming.daily import ingest_daily  # noqa: F401
