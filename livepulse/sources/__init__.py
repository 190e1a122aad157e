"""Sources and sinks (batch and streaming)."""

from livepulse.sources.tables import (  # noqa: F401
    read_or_empty, read_table, register_views, table, write_append)
from livepulse.sources.streams import (  # noqa: F401
    append_stream, await_any, broker_stream, table_stream, trigger_options)
