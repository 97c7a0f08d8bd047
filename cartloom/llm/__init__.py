"""Operators for training-data pipelines over document, page, conversation and vector tables."""
