"""DataFrame operators: de-duplication, joins under skew, numbering, merging, checks."""
