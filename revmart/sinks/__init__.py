"""Table writes that survive executor loss and driver crashes.

Plain parquet has no transactions, so every rewritten table is *versioned*:
a run writes ``<root>/v=<version>/`` and Spark's job commit drops
``_SUCCESS`` there last. Readers take the greatest committed version, so a
crashed run leaves at most an ignored folder, and re-running the same
version overwrites only its own folder. Overwriting the folder being read
(which destroys it) never happens: a run reads version N and writes N+1.

Append-only tables write one folder per batch (``batch=<id>``), again
overwritten only by a re-run of the same batch, so re-runs stay idempotent.
"""
