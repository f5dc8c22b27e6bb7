"""Chunk, index, shard and summary writers."""
