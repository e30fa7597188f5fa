"""End-to-end jobs: refine, dimensions, facts, marts and the monthly run."""
