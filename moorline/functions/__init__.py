from moorline.functions.columns import (
    context_field,
    context_map,
    epoch_micros,
    iso_text,
    json_context,
    json_is_malformed,
    malformed,
    micros_to_timestamp,
    parsed_json,
    run_duration,
    run_key,
    run_status,
    split_list,
    value_or_default,
)
