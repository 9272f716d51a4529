"""Reading, routing, exporting and compacting document tables."""
