"""Readers and writers: the only places, with streaming, that know paths."""
