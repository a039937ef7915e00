"""Composite jobs of the five subject areas and the star schema."""
