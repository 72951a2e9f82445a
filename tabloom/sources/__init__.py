"""Readers, sinks and fitted-artifact storage."""
