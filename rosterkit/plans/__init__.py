"""The three user-level jobs."""
