"""Stand-ins for the upstream producers: they write rows as the files the
engine reads. Fixtures of the source queries and tests, not part of the engine.
"""
