"""Ways to read a topic log."""
