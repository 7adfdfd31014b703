"""Named queries over the operators, and the SQL that states them."""
