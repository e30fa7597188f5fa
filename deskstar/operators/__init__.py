"""DataFrame operators: lookups, de-duplication, keys, upserts, capacity and quality."""
