"""Treasury and cash-flow analytics as Spark DataFrame operators."""
