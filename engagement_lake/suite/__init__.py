"""The registered queries: Spark frames over generic tables, and the SQL that checks them."""
