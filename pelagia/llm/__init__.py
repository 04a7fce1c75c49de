"""Operators for building language-model training data, and the queries that apply them to whole tables."""
