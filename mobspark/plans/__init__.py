"""Reports: functions from the case tables (and per-case parameters) to a DataFrame."""
