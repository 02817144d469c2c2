"""Whole jobs: reports, reference tables and the loads of each project."""
