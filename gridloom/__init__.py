"""gridloom: Spark-first analytics over semi-structured statistical tables."""
