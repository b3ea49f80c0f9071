"""Idempotent table sinks (SNK-1 … SNK-7)."""
