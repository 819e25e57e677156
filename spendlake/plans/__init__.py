"""Whole-table jobs and the mapping of the shared test tables onto the input schemas."""
