"""DataFrame-to-DataFrame operators: dedup, cleaning, joins, rules, marts."""
