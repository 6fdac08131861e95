"""Readers for snapshots, payloads, manifests and CSV files."""
