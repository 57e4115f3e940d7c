"""Composite feature plans built from DataFrame operators."""
