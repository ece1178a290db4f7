"""Column functions: paths, prefixes, domains, instants and lists as text."""
