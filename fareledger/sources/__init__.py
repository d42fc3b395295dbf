"""File contracts, manifests, readers and table sinks."""
