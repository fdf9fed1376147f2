"""Recipes: the operators composed per table, and the folder-to-catalog run."""
