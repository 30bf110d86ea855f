"""Compositions of sources and operators into layers and the full run."""
