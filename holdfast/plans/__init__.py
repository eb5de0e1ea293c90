"""End-to-end jobs: each reads stored tables, applies operators and stores its result."""
