"""End-to-end jobs: index builds and searches."""
