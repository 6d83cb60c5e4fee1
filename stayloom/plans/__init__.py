"""Whole jobs: cohort linkage, master export, training set, features, evaluation."""
