"""Whole jobs: gold marts and the layer-to-layer flow of one entity."""
