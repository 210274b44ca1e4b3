"""Table writes: merge, partition overwrite, compaction, export."""
