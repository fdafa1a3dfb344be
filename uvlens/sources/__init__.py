from uvlens.sources.tables import read_table
from uvlens.sources.behaviors import (
    behaviors_from_events, load_behaviors, orders_as_behaviors, with_event_time,
    parse_messages, split_messages, events_as_messages, MESSAGE_SCHEMA,
)

__all__ = [
    "read_table", "behaviors_from_events", "load_behaviors", "orders_as_behaviors",
    "with_event_time", "parse_messages", "split_messages", "events_as_messages",
    "MESSAGE_SCHEMA",
]
