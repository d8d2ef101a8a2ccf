"""DataFrame -> DataFrame operators; nothing here triggers a Spark job."""
