"""File trees, landed search pages and state documents as DataFrames."""
