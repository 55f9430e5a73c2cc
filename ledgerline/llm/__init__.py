"""Operators that prepare text for training language models. Nothing outside imports this package."""
