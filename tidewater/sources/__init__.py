"""Readers for the raw feeds and writers for the tables the jobs leave behind."""
