"""Part of lymphora."""
