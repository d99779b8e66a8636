"""Named queries over the test tables, with the SQL that states what each must return."""
