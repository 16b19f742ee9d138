"""Readers: file listings, images, annotation formats, CSV and JSON."""
