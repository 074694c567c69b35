"""Reading snapshots, header handling, providers and the lead sink."""
