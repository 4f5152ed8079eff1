"""Reading files, envelopes and snapshots; writing tables, CSV, JSON and batches."""
