"""Readers: log text, day directories, result files, stored history."""
