"""Sources and sinks: CSV landing and Parquet artefacts (files), adapters
from the TPC-H-style test tables (tpch)."""
