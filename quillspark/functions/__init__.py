"""Column-level helpers: JSON paths, tagged fields, rendering, type names."""

from quillspark.functions.scalar import (  # noqa: F401
    ansi_type_name,
    guarded_int,
    json_fields,
    like_any,
    prefix_columns,
    render_rows,
    tagged_field,
)
