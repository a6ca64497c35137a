"""The registered queries: their inputs, the jobs, and the SQL that checks them."""
