"""Sinks (K1-K4): JSONL samples, one-element-array JSONL, statistics, split outputs."""
