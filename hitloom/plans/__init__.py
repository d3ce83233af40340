"""Compositions: layers from raw to gold, quality checks, reports, traces."""
