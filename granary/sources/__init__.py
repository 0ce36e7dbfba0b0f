"""Readers: raw files, feeds, archives, and the parsers that turn bulletins into quote rows."""
