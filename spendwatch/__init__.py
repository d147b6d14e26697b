"""Payment event processing and windowed spend alerts on Spark."""
