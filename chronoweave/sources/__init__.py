"""Readers and writers of session files and episode datasets."""
