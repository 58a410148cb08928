"""Named queries over the test tables, with the SQL that each is checked against."""
