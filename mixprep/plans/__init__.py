"""User-level pipelines (W1-W5), fixtures and the registry of named queries."""
