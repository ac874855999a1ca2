"""Ways to write records to a topic log."""
