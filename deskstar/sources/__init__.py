"""Readers and writers of the lake layers and the warehouse tables."""
