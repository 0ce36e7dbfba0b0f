"""Relational operators over quotes, collections and their dimensions; all take column names, so any table will do."""
