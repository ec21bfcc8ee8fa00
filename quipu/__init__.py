"""Quipu: event-sourced ledger analytics on PySpark DataFrames."""

from quipu.config import LedgerConfig, default_config, load_config

__all__ = ["LedgerConfig", "default_config", "load_config"]
