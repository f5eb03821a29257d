"""Education data marts as PySpark DataFrame functions."""
