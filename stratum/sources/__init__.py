"""Reading the raw feeds, writing the layers, and scratch space."""
