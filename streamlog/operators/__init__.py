"""DataFrame operators over records, offsets and delivery tables."""
