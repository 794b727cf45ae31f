"""DataFrame -> DataFrame operators (and the warehouse that publishes their results)."""
