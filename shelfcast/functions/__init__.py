"""Column expressions (no UDFs): calendar features, display formats, statistics."""
