"""Operators: profiling, quality report and gate, cleaning rules, star-schema
marts, declarative column tests, report metrics and per-series forecasting."""
