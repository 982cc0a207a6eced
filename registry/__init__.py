"""The queries this repository registers, and the SQL that checks them."""
