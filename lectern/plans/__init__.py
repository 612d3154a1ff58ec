"""Whole jobs: index build, retrieval, answering, evaluation."""
