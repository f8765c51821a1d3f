"""Dataflow operators: profiles, rules, scores, sequences, repairs and governance."""
