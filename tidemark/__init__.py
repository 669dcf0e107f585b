"""Analytics over daily market series and training-data tables, on Spark."""
