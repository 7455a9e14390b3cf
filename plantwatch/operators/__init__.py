"""Reusable operators: joins, rules, checks, profiles, quantiles, ranks, correlation."""
