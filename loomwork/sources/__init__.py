"""Readers of the raw inputs and writers of text results."""
