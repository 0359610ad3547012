from quotewright.sinks.tables import (  # noqa: F401
    append_rows,
    compact,
    merge_rows,
    overwrite_table,
    replace_partitions,
    upsert,
)
