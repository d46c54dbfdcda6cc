"""Raw-shaped inputs made from the test tables, the registered queries and their SQL."""
