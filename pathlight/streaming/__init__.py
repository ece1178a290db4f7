"""Streams of routing updates: the routing table as it changes, alerts, and the state of pairs."""
