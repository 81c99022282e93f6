"""Feature preparation and tree models on Spark ML."""
