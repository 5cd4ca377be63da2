"""Where rows come from and where they go."""

from feedkit.sources.readers import (
    active_team_names,
    feed_scan,
    footer_maximum,
    high_water_mark,
    html_files,
    known_names,
    latest_dated,
    latest_snapshot,
    listed_names,
    lookup_pairs,
    name_pairs,
    scalar_query,
    sql_query,
    stored_mark,
    table_scan,
    text_lines,
)
from feedkit.sources.writers import (
    append_batch,
    append_rows,
    read_batches,
    rewrite_parts,
    to_schema,
    write_named,
    write_observed,
    write_values,
    write_version,
    write_version_csv,
)

__all__ = [
    "active_team_names",
    "append_batch",
    "append_rows",
    "feed_scan",
    "footer_maximum",
    "high_water_mark",
    "html_files",
    "known_names",
    "latest_dated",
    "latest_snapshot",
    "listed_names",
    "lookup_pairs",
    "name_pairs",
    "read_batches",
    "rewrite_parts",
    "scalar_query",
    "sql_query",
    "stored_mark",
    "table_scan",
    "text_lines",
    "to_schema",
    "write_named",
    "write_observed",
    "write_values",
    "write_version",
    "write_version_csv",
]
