"""Table loaders, type normalisation and writers (upsert, partition overwrite, append, schema evolution)."""
