"""Incremental ingestion with Structured Streaming (no new semantics).

The reference's inputs are bounded files, so nothing here is required for
equal results; it runs the same stateless steps (S1 read, D5 normalise, F1
filter) on JSONL files as they land, for deployments that receive sample drops
continuously. Splitting, sampling and statistics stay batch jobs over the
landed table, since they need every row of a group.
"""

from mixprep.streaming.ingest import start_ingest  # noqa: F401
