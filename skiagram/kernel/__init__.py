"""Pixels of one frame to particles: pure NumPy, run inside Arrow batches by operators.detect."""
