"""Whole jobs: harmonise, unify, correct, complete, annotate, fill, reconcile, standardise."""
