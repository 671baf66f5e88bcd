"""salescast: hierarchical retail-sales forecasting analytics as Spark jobs."""
