"""Column functions: paths, text rules, tokens, units, search keys, HTML records."""
