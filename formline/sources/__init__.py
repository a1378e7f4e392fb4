"""Readers and writers for the files the tables live in."""
