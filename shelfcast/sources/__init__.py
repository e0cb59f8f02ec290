"""Readers and writers: driver tables, CSV inputs, sinks, run and model stores."""
