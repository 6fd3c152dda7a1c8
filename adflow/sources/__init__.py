"""Readers, sinks and generators."""
