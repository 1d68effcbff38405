"""End-to-end plans: range runs, analyst queries and the registered queries."""
