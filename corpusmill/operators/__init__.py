"""DataFrame operators: extraction, roll-ups, packing, discovery, frontiers."""
