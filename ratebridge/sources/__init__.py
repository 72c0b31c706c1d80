"""Sources and sinks: raw JSON Lines, catalog tables, landed payloads, fixture adapters."""
