"""Readers and the snapshot tables that hold zones and collections."""
