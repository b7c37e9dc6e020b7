"""tillroll: retail point-of-sale analytics as PySpark DataFrame programs."""
