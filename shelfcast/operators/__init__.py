"""DataFrame operators on the store x day panel."""
