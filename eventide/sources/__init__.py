from eventide.sources.tables import events, from_rows, read_table, table_path, with_millis
from eventide.sources.streams import event_stream, text_lines

__all__ = ["events", "from_rows", "read_table", "table_path", "with_millis",
           "event_stream", "text_lines"]
