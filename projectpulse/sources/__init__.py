"""Sources and sinks: Parquet/CSV readers, overwrite sinks, extracts."""

from projectpulse.sources.readers import (  # noqa: F401
    materialize,
    read_csv,
    read_table,
    register,
    string_schema,
    table_counts,
    table_path,
    write_csv,
    write_table,
)
