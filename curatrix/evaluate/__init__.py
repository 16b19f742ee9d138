"""Evaluation of detectors and of text recognition."""
