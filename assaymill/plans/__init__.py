"""Registered queries: plans over whole tables, with the SQL they are checked against where SQL can express them."""
