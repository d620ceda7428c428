"""Sources (raw CSV scan, schema checks, ingest metadata, the raw view derived
from the driver tables) and sinks (table writes, partitioned layouts, exports)."""
