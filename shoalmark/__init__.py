"""Entity directory engine on Spark."""
