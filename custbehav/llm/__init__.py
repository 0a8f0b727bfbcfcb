"""Operators for preparing training data at scale, their queries, and the stages of the corpus pipeline."""
