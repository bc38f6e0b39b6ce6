"""Readers for matrix and annotation files, and the table reader/writer."""
