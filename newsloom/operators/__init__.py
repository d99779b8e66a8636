"""Operators over DataFrames: matching, scoring, facets, rules, archive merges, aggregates, evaluation."""
