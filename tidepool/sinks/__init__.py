"""Sinks (SNK-1..7): console/memory, Kafka shaping, upserts, documents, routing."""

from tidepool.sinks.writers import (document_records, hash_upsert, latest_per_key, merge_upsert,
                                    print_sink, route_write, upsert_batch_writer)

__all__ = ["document_records", "hash_upsert", "latest_per_key", "merge_upsert", "print_sink",
           "route_write", "upsert_batch_writer"]
