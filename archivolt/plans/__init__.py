"""Query plans over the benchmark tables, with the SQL that checks them."""
