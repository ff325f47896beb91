"""Relational operators: cleaning, dimensions, facts, star joins, rules, profiles."""
