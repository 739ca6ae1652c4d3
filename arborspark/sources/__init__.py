"""Readers and writers for skeleton text, synapse text, metadata and meshes."""
