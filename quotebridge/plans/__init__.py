"""Whole plans: supplier feed to canonical quotes, and the jobs that read and write tables."""
