"""Search-to-booking clickstream analytics as Spark DataFrame operators."""
