"""Flight-delay and weather analytics as plain PySpark DataFrame functions."""
