"""Reading and writing: raw feeds, dimension snapshots, facts, catalog."""
