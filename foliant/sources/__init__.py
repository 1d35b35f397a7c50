"""Readers and writers for the files of the book pipeline."""
