"""Composite questions and the job runner."""
