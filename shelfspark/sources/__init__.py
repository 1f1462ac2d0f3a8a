"""Sources and sinks: driver tables, landed JSON documents, raw/warehouse tables, parquet."""
