"""shelfcast — retail sales analytics and forecasting on a store x day panel,
expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
