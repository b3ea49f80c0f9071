"""Correctness oracles: DuckDB SQL twins of the registered queries."""
