"""Scans, catalog rows and table writes."""

from quillspark.sources.catalog import describe_columns, empty_table  # noqa: F401
from quillspark.sources.storage import (  # noqa: F401
    append_rows,
    delete_where,
    preview,
    snapshot,
    truncate,
)
from quillspark.sources.text import (  # noqa: F401
    export_as_text,
    export_since,
    load_history,
    next_mark,
    parse_delimited,
    read_lines,
)
