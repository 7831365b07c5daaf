"""Readers and writers for report snapshots and the warehouse."""
