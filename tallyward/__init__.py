"""Claims and admissions analytics as plain PySpark DataFrame operators."""
