"""Sources and sinks: delimited season files, table sets, catalogue."""

from touchline.sources.delimited import (
    Field, load_counted, load_delimited, load_numbered, parse_failures, read_ordered, read_text, typed, write_delimited, write_ordered,
)
from touchline.sources.layouts import LAYOUTS, LOAD_ORDER
from touchline.sources.tables import current_tables, read_tables, register_views, reload_tables

__all__ = [
    "Field",
    "LAYOUTS",
    "LOAD_ORDER",
    "current_tables",
    "load_counted",
    "load_delimited",
    "load_numbered",
    "parse_failures",
    "read_ordered",
    "read_tables",
    "read_text",
    "register_views",
    "reload_tables",
    "typed",
    "write_delimited",
    "write_ordered",
]
