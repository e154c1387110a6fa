"""Readers and writers for the tables and files of the lake."""
