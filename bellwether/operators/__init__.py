"""Cleaning, returns, factor model, similarity, selection and studies."""
