"""Flows over a lake and the read side of its governance tables."""
