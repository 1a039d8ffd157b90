"""A PySpark engine for curating media-clip manifests at scale."""
