"""Change streams over staged files."""

from quillspark.streaming.streams import (  # noqa: F401
    append_writer,
    backlog,
    discard,
    drain_once,
    event_stream,
    has_data,
    new_checkpoint,
    pending_files,
    read_appended,
    read_typed_table,
    resync,
    start_task,
    typed_table_writer,
    wait_idle,
)
