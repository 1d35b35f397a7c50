"""Composite jobs: the public face of the package."""
