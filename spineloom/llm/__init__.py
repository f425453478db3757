"""Operators of a training-data pipeline: cleaning, near duplicates, decontamination, tokens and models of text."""
