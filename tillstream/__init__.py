"""Commerce analytics on Spark: app logs, change capture, dimensions, orders, serving and search."""
