"""Readers: tables, files, the crawl plan and saved models."""
