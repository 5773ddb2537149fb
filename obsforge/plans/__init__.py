"""End-to-end load and the star-schema queries."""
