"""textloom: text analytics as Spark DataFrame operators."""
