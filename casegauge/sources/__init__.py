"""Readers, snapshot selection and sinks."""
