"""Table contracts, file scans and sinks."""
