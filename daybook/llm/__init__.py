"""Operators for training data: text, vectors and URLs at corpus scale."""
