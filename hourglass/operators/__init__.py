"""DataFrame -> DataFrame building blocks.  No collect(), no Python UDFs."""
