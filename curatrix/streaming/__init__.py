"""Streams of decision logs: an extension, as batch curation needs none."""
