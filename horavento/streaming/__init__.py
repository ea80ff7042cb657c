"""Incremental and streaming jobs (R1-R9): Structured Streaming with checkpoints
in the shared folder, ``foreachBatch`` for merges, ``availableNow`` for once mode."""
