"""Market time-series feature engine built on the Spark DataFrame API."""
