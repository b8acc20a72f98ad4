from moorline.sources.files import (
    BAD_RECORD,
    Source,
    csv_to_orc,
    read_any,
    read_csv,
    read_inferred_csv,
    read_json,
    read_orc,
    read_parquet,
    register_sources,
)
from moorline.sources.quarantine import read_quarantined, split_bad_records, write_with_quarantine
from moorline.sources.tables import literal_rows, look_up, read_catalog, read_control_table, read_key_values
