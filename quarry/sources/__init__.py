"""Scans and sinks: JSON files (A1), catalog CSV (A3, K1), vector tables (A4, K4, K5),
audit log (K6, A6), crawl outputs (K2, K3), driver tables and table streams."""
