"""Snapshot tables and nested JSON documents."""
