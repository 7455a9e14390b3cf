"""Named queries over the given tables, and the SQL that each must agree with."""
