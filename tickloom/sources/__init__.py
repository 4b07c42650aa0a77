"""Readers, landing-zone mappings and sinks."""
