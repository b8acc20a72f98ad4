from moorline.sinks.catalog import (
    add_partitions,
    create_database,
    create_external_table,
    drop_partitions,
    external_table_ddl,
    partition_counts,
    published_partitions,
    register_view,
    repair_table,
    show_partitions,
    write_registered,
)
from moorline.sinks.publish import atomic_publish, finish_upsert, skip_published, upsert_into
from moorline.sinks.versions import (
    Published,
    current_version,
    drop_versions,
    point_at,
    publish_version,
    read_version,
    upsert_version,
)
from moorline.sinks.write import (
    Written,
    bucket_count,
    partition_columns,
    write_bucketed,
    write_counted,
    write_df,
    write_indexed,
    write_orc,
    write_partitions,
)
