"""Operators of a training-data pipeline over documents and pages.

Nothing else in the library imports this subpackage; it uses the library's
general session helpers only."""
