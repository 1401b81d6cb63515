"""Reading landed documents and stored tables, and writing tables and exports."""

from matchlake.sources.landing import Landing, json_envelope, split_documents
from matchlake.sources.sinks import (
    export_csv,
    export_parquet,
    merge_where,
    save_new,
    save_upsert,
    save_upsert_where,
    write_table,
)
from matchlake.sources.tables import (
    read_days,
    read_partition_day,
    read_partition_days,
    read_table,
    table_exists,
    table_path,
)

__all__ = [
    "Landing",
    "export_csv",
    "export_parquet",
    "json_envelope",
    "merge_where",
    "read_days",
    "read_partition_day",
    "read_partition_days",
    "read_table",
    "save_new",
    "save_upsert",
    "save_upsert_where",
    "split_documents",
    "table_exists",
    "table_path",
    "write_table",
]
