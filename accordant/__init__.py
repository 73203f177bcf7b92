"""accordant: record deduplication and entity resolution as lazy Spark plans."""
