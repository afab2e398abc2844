"""Readers and writers: landed pages, message streams, JDBC tables, the star store."""

from sensormart.sources.messages import (
    decode_messages,
    encode_messages,
    kafka_sink_options,
    kafka_source_options,
    parse_messages,
    read_message_files,
    read_topic,
    write_topic,
)
from sensormart.sources.pages import has_geo, read_documents, read_pages, unnest_results
from sensormart.sources.store import StarStore

__all__ = [
    "StarStore",
    "decode_messages",
    "encode_messages",
    "has_geo",
    "kafka_sink_options",
    "kafka_source_options",
    "parse_messages",
    "read_documents",
    "read_message_files",
    "read_pages",
    "read_topic",
    "unnest_results",
    "write_topic",
]
