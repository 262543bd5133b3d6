"""Readers, writers, scenario generators and the adapters from the star-schema tables."""
