"""Readers and writers: landing files and the layers of the lake."""
