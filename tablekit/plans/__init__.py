"""Reusable distributed plan patterns (global ranking, bucketed scans) and
the driver bindings (operator -> test tables, oracle SQL)."""
