"""Sources and sinks: routing dumps, archives' manifests, text and JSON tables, snapshots by day, a registry crawl."""
