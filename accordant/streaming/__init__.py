"""An extension: deduplication of a stream of record files. The batch engine has no streams of its own."""
