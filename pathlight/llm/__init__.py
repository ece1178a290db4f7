"""Training-data operators; see ``registry`` for the queries and ``README.md`` for the method of each."""
