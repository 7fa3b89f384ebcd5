"""Sources and sinks: schema contracts, CSV / GeoJSON ingest, table writes."""
