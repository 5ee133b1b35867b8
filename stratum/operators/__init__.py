"""Relational operators that need more than one DataFrame call to run well at scale."""
