from moorline.operators.aggregates import (
    Measure,
    breakdown_rollup,
    collect_records,
    grouped_measures,
    partition_breakdown,
    rows_processed,
    settings_columns,
    settings_maps,
    total_count,
    without_key,
)
from moorline.operators.changes import detect_changes, unique_per_key, upsert
from moorline.operators.graph import CycleError, dependency_closure, dependency_cycles, dependency_levels, direct_dependencies
from moorline.operators.joins import Dimension, lookup_join, repeated_keys, star_join, typed_keys, unmatched
from moorline.operators.latest import first_per_key, latest_per_key, merge_layers
from moorline.operators.project import (
    bind_constants,
    date_window,
    equal_to,
    inject_defaults,
    iso_record,
    json_record,
    require_params,
    require_values,
    with_derived,
)
from moorline.operators.quality import null_profile, table_sample, validate_non_null, verify_tables
from moorline.operators.split import RESIDUAL, label_status, split_by_status, union_outputs
