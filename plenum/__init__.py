"""Co-voting network analytics as Spark DataFrame operators."""
