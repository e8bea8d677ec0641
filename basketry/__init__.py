"""Weekly retail recommendations as lazy PySpark operators."""
