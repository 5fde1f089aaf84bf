"""Event-window analytics for glucose time series, as Spark DataFrame transformations."""
