"""Whole plans: one pass over the loans, and the job that writes every table."""
