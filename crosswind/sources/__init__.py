"""Readers: flight, weather and dimension files, and rows of HTML pages."""
