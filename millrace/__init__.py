"""Land keyed event streams exactly once with PySpark, and prove that they landed."""
