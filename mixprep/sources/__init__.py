"""Sources (S1-S10): JSONL samples, directories, keyed parquet maps, user profiles."""
