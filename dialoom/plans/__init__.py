"""Composed operators: preprocessing and the whole curation run."""
