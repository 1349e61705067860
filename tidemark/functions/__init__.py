"""Scalar column functions: JSON parsing, time shifts, text rules."""

from tidemark.functions.json import (json_map, member,
                                     project_event, project_properties, to_json_object)
from tidemark.functions.text import composite_key, java_split_space, text_hash, text_lines
from tidemark.functions.time import (epoch_ms_to_ts, local_text,
                                     local_text_from_ms, ntz_micros, register_utc2local, utc2local)

__all__ = [
    "composite_key", "epoch_ms_to_ts", "java_split_space", "json_map", "local_text", "local_text_from_ms", "member",
    "ntz_micros", "project_event", "project_properties", "register_utc2local",
    "text_hash", "text_lines", "to_json_object", "utc2local",
]
