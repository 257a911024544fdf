"""DataFrame-to-DataFrame operators: lists, joins, folds, merges, audits, trends."""
